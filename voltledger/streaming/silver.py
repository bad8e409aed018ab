"""Landed prices as a stream that keeps every delivery once.

Providers deliver files and time ranges again.  Bronze keeps every delivery for the audit; this stream reads
Bronze as it grows and lets a price through once per market, commodity and timestamp.  Spark holds the keys
seen in its state store for ``delay`` of event time, so state is bounded by the rate of prices and not by the age of
the stream, and the checkpoint carries it over restarts.  The first delivery wins.

Deliveries whose timestamp lies further back than ``delay`` behind the newest one are dropped by the
watermark; a back-fill of that age goes through the batch form (``sources.bronze.landed_prices``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltledger.sources.bronze import BRONZE_SCHEMA

KEY = ("market", "commodity", "timestamp_ms")
DELAY = "7 days"


def first_deliveries(landed: DataFrame, delay: str = DELAY) -> DataFrame:
    """Landed rows (a stream) without repeated deliveries; rows without a timestamp or price are left out."""
    timed = landed.where("timestamp_ms IS NOT NULL AND price_eur_mwh IS NOT NULL").withColumn(
        "timestamp", F.timestamp_millis("timestamp_ms"))
    return timed.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(KEY)).select(
        "timestamp", "timestamp_ms", "price_eur_mwh", "market", "commodity", "currency", "unit", "ingest_stamp")


def stream_silver(
    spark: SparkSession, bronze: str, out: str, checkpoint: str, delay: str = DELAY, files_per_batch: int = 64,
) -> StreamingQuery:
    """Append what is new in Bronze to the table at ``out``; the file sink commits a batch once."""
    landed = spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(bronze)
    return (
        first_deliveries(landed, delay).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
