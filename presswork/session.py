"""Session defaults, durable intermediate tables and small-table checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Upper bound for anything a job copies to every task (model matrices, pivots).
BROADCAST_BYTES = 256 * 1024 * 1024


def build_session(app: str = "presswork", cpus: int | str = "*", **conf) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the cluster's own."""
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    names none gets a temporary folder; anywhere else that is an error, because
    an executor could not read another machine's disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        # local-cluster[...] has executors of its own, so it counts as a cluster.
        if context.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="presswork-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts lineage, survives the loss of executors, runs the plan a single
    time (``checkpoint()`` runs it twice unless cached) and gives Catalyst the
    true size, so later joins choose broadcast or shuffle by measurement.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-distribute an input that has fewer splits than the cluster has cores.

    A table of one Parquet row group is read by one task; text work on it would
    use one core. Large tables have many more splits and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() <= cores:
        return df.repartition(cores, key)
    return df


def require_broadcastable(n_values: int, what: str) -> None:
    """Refuse to ship more than BROADCAST_BYTES of doubles to every task."""
    if n_values * 8 > BROADCAST_BYTES:
        raise ValueError(f"{what}: {n_values} doubles exceed the {BROADCAST_BYTES}-byte limit")


def scalar(df: DataFrame, aggregate) -> F.Column:
    """A one-value aggregate of ``df`` as a scalar subquery column."""
    return df.agg(aggregate.alias("v")).scalar()
