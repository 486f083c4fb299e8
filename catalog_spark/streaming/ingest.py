"""Incremental ingest of JSON lines with keyed deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import once
from ..operators.flatten import first_filled
from ..operators.relate import drop_blank_keys
from ..sources.files import parse_lines

# Keys are kept on the executors' disks, not in their heaps.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A count of the keys would cost another look at the store for each key written.
COUNT_KEYS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
STORE_PATHS = [("_store_id",), ("store_id",)]
ITEM_PATHS = [("_tcin",), ("tcin",), ("data", "product", "tcin")]


def keyed_documents(lines: DataFrame, time_path: tuple[str, ...] | None = None) -> DataFrame:
    """(store_id, tcin, line[, event_time]) of every well-formed document with both keys."""
    docs = parse_lines(lines).where("status = 'ok'")
    columns = [first_filled(F.col("doc"), STORE_PATHS).alias("store_id"), first_filled(F.col("doc"), ITEM_PATHS).alias("tcin"), "line"]
    if time_path:
        columns.append(first_filled(F.col("doc"), [time_path]).try_cast("timestamp").alias("event_time"))
    docs = docs.select(once(F.struct(*columns)).alias("__k")).select("__k.*")
    return drop_blank_keys(docs, ["store_id", "tcin"])


def ingest_new(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    watermark: str | None = None,
    time_path: tuple[str, ...] = ("_fetched_at",),
    max_files: int | None = None,
) -> StreamingQuery:
    """Process the files that arrived since the last run and append unseen (store, item) documents.

    Progress and the seen keys are in the checkpoint: a restart goes on where the
    last run stopped, and the file sink commits each batch once.  ``max_files``
    bounds a batch, and with it how much of one hot key a task can get.  Keys are kept
    for good, as a re-delivered document may be of any age; ``watermark`` bounds
    them at the price of forgetting keys older than that.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set(COUNT_KEYS, "false")
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    documents = keyed_documents(reader.load(source), time_path if watermark else None)
    if watermark:
        unique = documents.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["store_id", "tcin"])
    else:
        unique = documents.dropDuplicates(["store_id", "tcin"])
    return (
        unique.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
