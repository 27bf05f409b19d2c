"""The daily impression append as an incremental stream over newly arrived batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeledger.functions.dates import local_date
from tradeledger.plans.impressions import event_rows, impression_flatten, malformed_batches
from tradeledger.session import cut_lineage, hadoop_exists

BATCH_SCHEMA = (
    "location string, region_name string, batch_time timestamp, anonymous_id string, events string"
)


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batch files as a stream; new files are picked up by the next run."""
    return spark.readStream.schema(BATCH_SCHEMA).parquet(folder)


def _load_id(spark: SparkSession, checkpoint: str, epoch: int) -> str:
    """Name of an epoch of the query that owns the checkpoint; a new checkpoint never names an old epoch."""
    kept = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
    return f"{kept}-{epoch}"


def _replace_load(rows: DataFrame, path: str, load: str, partitions: list[str]) -> None:
    """Write what an epoch adds, in partitions of its own, in place of what an earlier try left there."""
    (
        rows.withColumn("load_id", F.lit(load))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "load_id")
        .parquet(path)
    )


#: What tells batches apart. Two batches of one user, time and location with other events are both kept.
BATCH_KEY = ["anonymous_id", "batch_time", "location", "events_hash"]

_KNOWN_SCHEMA = (
    "anonymous_id string, batch_time timestamp, location string, events_hash bigint, local_day date, load_id string"
)


def append_impressions(
    batches: DataFrame,
    target: str,
    checkpoint: str,
    location: str | None = "Home",
    tz: str = "America/Los_Angeles",
    rejects: str | None = None,
) -> StreamingQuery:
    """Append the impressions of all new batches, one partition per local day and load, then stop.

    A batch is known by user, time, location and a hash of its events. Of the batches of the location that
    hold impressions, those sent again are dropped before they are unnested: within a run by their key, and
    against the partitions of the days in question, so a batch of any age reaches its day and no state is
    kept between runs. Batches that cannot be read go to ``rejects`` (``target`` and "-rejects" by default).

    Every epoch writes partitions named after it (``load_id``). An epoch that is run again after a failure
    does not count its own earlier rows as known and replaces them, so impressions and rejects are there
    once, wherever it broke off.
    """
    refused = rejects or f"{target}-rejects"

    def write(arrived: DataFrame, epoch: int) -> None:
        spark = arrived.sparkSession
        load = _load_id(spark, checkpoint, epoch)
        day = local_date(F.col("batch_time").cast("timestamp_ntz"), tz)
        chosen = arrived if location is None else arrived.filter(F.col("location") == location)
        # Unreadable and empty batches must not stand for a good one of the same key.
        once = (
            chosen.filter(F.size(event_rows()) > 0)
            .withColumns({"local_day": day, "events_hash": F.xxhash64("events")})
            .dropDuplicates(BATCH_KEY)
        )
        if hadoop_exists(spark, target):
            days = once.select("local_day").distinct()
            stored = spark.read.schema(_KNOWN_SCHEMA).parquet(target).filter(F.col("load_id") != load)
            known = stored.join(days, "local_day", "left_semi").select(*BATCH_KEY).distinct()
            known = known.toDF(*[f"_{c}" for c in BATCH_KEY])
            once = once.join(known, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in BATCH_KEY], "left_anti")
        flat = impression_flatten(once, location, tz, keep=["batch_time", "events_hash", "local_day"])
        # The target is read for what is known, so its new rows are kept before they replace any.
        _replace_load(cut_lineage(flat), target, load, ["local_day"])
        _replace_load(malformed_batches(arrived, location), refused, load, [])

    return (
        batches.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
