"""Session defaults and table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "normwerk", **conf: str) -> SparkSession:
    """A session with the engine's defaults; anything passed or already set in the environment wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=DEFAULTS | conf).getOrCreate()


#: Largest table, in bytes of its files, that is dealt out to idle cores; beyond, a shuffle of it costs more than it spares.
DEALT_BYTES = 2**30


def table(spark: SparkSession, root: str, name: str, heavy: bool = False, columns: tuple[str, ...] = ()) -> DataFrame:
    """One Parquet table of a data directory (a file or a directory of files), all columns or those named.

    ``heavy``: each row takes long to work out. A small table in fewer parts than there are cores is then dealt out to all of
    them; a table of many parts, or a large one, is read as it lies, without a shuffle.
    """
    df = spark.read.parquet(f"{root}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    if heavy and df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism and _file_bytes(df) <= DEALT_BYTES:
        # each row through a generator: the optimiser would else move filters, and their work, before the exchange
        return spread(df).select(F.explode(F.array(F.struct(*df.columns))).alias("r")).select("r.*")
    return df


def _file_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """As many partitions as the session works on at once, however small the data: for rows that take long to work out each.

    A number that is asked for isn't merged by the adaptive planner, which goes by bytes.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *by)
