"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Paths and tables of the innermost open ``stage_scope``, if there is one.
_SCOPE: ContextVar[tuple[list[str], list[str]] | None] = ContextVar("stages", default=None)


def build_session(app: str = "tradeledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan here relies on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (SKEW_SETTINGS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tradeledger-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    written = _SCOPE.get()
    if written is not None:
        written[0].append(path)
    return path


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the stages written inside, also after an error.

    Results may read stages, so write or collect them before the scope ends. Stages of an inner scope go
    with that one. Without a scope they stay until the caller removes the shared folder.
    """
    written: tuple[list[str], list[str]] = [], []
    token = _SCOPE.set(written)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for name in written[1]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for name in written[0]:
            remove_path(spark, name)


def hadoop_path(spark: SparkSession, name: str):
    """A path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, name: str) -> None:
    path, files = hadoop_path(spark, name)
    files.delete(path, True)


def hadoop_exists(spark: SparkSession, name: str) -> bool:
    path, files = hadoop_path(spark, name)
    return files.exists(path)


def drop_stage(stage: DataFrame) -> None:
    """Remove a stage of ``cut_lineage`` whose last reader has been written."""
    for name in stage.inputFiles()[:1]:
        remove_path(stage.sparkSession, name.rsplit("/", 1)[0])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    They survive the loss of any executor, and their size is known to the optimizer, which picks
    join strategies by it.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_stage(df: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """Write the rows bucketed by ``columns`` to the shared folder, as an unmanaged table, and read them back.

    Joins, windows and aggregates by these columns need no shuffle of the result. Rows should be
    dealt by these columns already, or every task writes a file per bucket.
    """
    spark, name = df.sparkSession, f"stage_{uuid.uuid4().hex}"
    path = scratch_path(spark, "bucketed")
    written = _SCOPE.get()
    if written is not None:
        written[1].append(name)
    df.write.format("parquet").option("path", path).bucketBy(min(buckets, MAX_BUCKETS), *columns).saveAsTable(name)
    return spark.table(name)


#: Spark's limit on the buckets of a table, as it stands by default.
MAX_BUCKETS = 100_000


# Split oversized partitions of joins even where that costs one more shuffle.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# MB of shuffle that Spark puts into one task, unless the session states it. A task of several sorts and aggregates
# holds up to 50 times that in memory, so Spark's 64 MB would let it grow to 3 GB.
ADVISORY_CONF = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
ADVISORY_SIZE = "24m"


def apply_skew_settings(spark: SparkSession) -> None:
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(ADVISORY_CONF, None) is None:
        spark.conf.set(ADVISORY_CONF, ADVISORY_SIZE)
