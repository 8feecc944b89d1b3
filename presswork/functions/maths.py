"""Numeric and hashing column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable so that it is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def hash_key(*parts) -> Column:
    """md5 of the parts joined with ``:``, the reproducible stand-in for a shuffle."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in columns]))


def hash_unit(*parts) -> Column:
    """A reproducible uniform draw in [0, 1) from the first 32 bits of ``hash_key``."""
    return F.conv(F.substring(hash_key(*parts), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def log_factorial(n: Column) -> Column:
    """ln(n!) without a table: exact products up to 20!, Stirling's series above."""
    x = n.cast("double") + 1.0
    series = (
        (x - 0.5) * F.log(x)
        - x
        + F.lit(0.9189385332046727)  # ln(2*pi)/2
        + 1.0 / (12.0 * x)
        - 1.0 / (360.0 * F.pow(x, 3))
        + 1.0 / (1260.0 * F.pow(x, 5))
        - 1.0 / (1680.0 * F.pow(x, 7))
    )
    small = F.log(F.factorial(n.cast("int")).cast("double"))
    return F.when(n <= 20, small).otherwise(series)


def poisson_draw(unit: Column) -> Column:
    """Poisson(1) multiplicity from a uniform draw: the bootstrap weight of a row."""
    # Cumulative Poisson(1) probabilities of 0..9.
    steps = [
        0.36787944117144233,
        0.7357588823428847,
        0.9196986029286058,
        0.9810118431238462,
        0.9963401531726563,
        0.9994058151824183,
        0.999916758850712,
        0.9999897508033253,
        0.999998874797402,
        0.9999998885745217,
    ]
    count = F.lit(0)
    for step in steps:
        count = count + (unit >= step).cast("int")
    return count
