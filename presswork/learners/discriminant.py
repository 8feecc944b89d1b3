"""Linear discriminant analysis per category from one set of moments."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from presswork.learners.bayes import NEVER
from presswork.learners.moments import class_moments, gram, score_rows
from presswork.learners.relevance import split


def linear_discriminant(data: DataFrame, names: list[str], test_fold: int | None = 2) -> DataFrame:
    """Shared covariance, class-frequency priors; score = log odds.

    The total scatter matrix is the same for every category, so one pass serves
    all of them: the within-class scatter is the total minus the between part.
    The small linear systems are solved on the driver.
    """
    train, test = split(data, test_fold)
    m = class_moments(train, names)
    scatter = gram(train, center=m.mean)
    weights = np.zeros_like(m.mean1)
    intercepts = np.zeros(len(names))
    for c in range(len(names)):
        n1, n0 = m.n1[c], m.n0[c]
        if n1 == 0 or n0 == 0:
            intercepts[c] = NEVER if n1 == 0 else -NEVER
            continue
        step = m.mean1[c] - m.mean0[c]
        within = (scatter - (n1 * n0 / m.n) * np.outer(step, step)) / (m.n - 2)
        weights[c] = np.linalg.lstsq(within, step, rcond=1e-12)[0]
        middle = (m.mean1[c] + m.mean0[c]) / 2
        intercepts[c] = np.log(n1 / n0) - middle @ weights[c]
    return score_rows(test, names, weights, intercepts)
