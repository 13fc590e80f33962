"""Session construction and the few settings every plan relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "marketloom", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the library is tested under (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one `spark.checkpoint.dir` names. Only a session in one process may do without: it gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="marketloom-"))
    return str(context.getCheckpointDir())


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder and read back, so that its lineage ends there.

    The written copy outlives a lost executor; see `shared_folder` for its place.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def counted_small(df: DataFrame, most: int) -> DataFrame:
    """`df`, marked for broadcast only if it was counted to have at most `most` rows; the plan joins by a shuffle beyond. Give what is cheap to count: a checkpoint."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
