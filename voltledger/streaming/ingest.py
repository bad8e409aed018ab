"""Secured ingest of arriving payload files.

A micro-batch is one file, because verdicts and robust statistics are defined per
batch. Each batch goes through exactly the steps of the batch form and lands under a
stamp made of its newest file's time and its files' names: it sorts among the stamps of batch
runs, a replayed micro-batch replaces itself, and another checkpoint erases nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltledger.functions.contracts import MARKET_PRICES, Contract
from voltledger.operators.scan import ContentThreat
from voltledger.plans.medallion import IngestionBlocked, secure_ingest
from voltledger.sources.bronze import landed_prices  # noqa: F401 - belongs to the stream's interface


def read_payload_stream(
    spark: SparkSession, source: str, files_per_batch: int = 1, whole_files: bool = True
) -> DataFrame:
    """Arriving JSON texts: one per file, or one per line where files are large."""
    return (
        spark.readStream.format("text").option("wholetext", whole_files).option("maxFilesPerTrigger", files_per_batch)
        .load(source).select(
            F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("json"),
            F.col("_metadata.file_modification_time").alias("modified"))
    )


def batch_stamp(batch: DataFrame) -> str:
    """Order-keeping stamp of a micro-batch: the time of its newest file, then a mark of its files."""
    files = batch.select("file", "modified").distinct()
    row = files.agg(
        F.date_format(F.max("modified"), "yyyyMMdd_HHmmss").alias("at"),
        F.lower(F.hex(F.pmod(F.sum(F.crc32(F.col("file"))), F.lit(1 << 32)))).alias("mark")).first()
    return f"{row['at']}_{row['mark']}"


def stream_ingest(
    spark: SparkSession, source: str, out: str, checkpoint: str,
    contract: Contract = MARKET_PRICES, on_block: str = "fail", whole_files: bool = True,
) -> StreamingQuery:
    """Start the stream over what is there now.

    A refused payload stops the stream (``on_block="fail"``) or is recorded below
    ``blocked`` and passed over (``"record"``).
    """
    if on_block not in ("fail", "record"):
        raise ValueError("on_block must be 'fail' or 'record'")

    def land(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        try:
            secure_ingest(batch, out, batch_stamp(batch), contract=contract)
        except (ContentThreat, IngestionBlocked) as refusal:
            if on_block == "fail":
                raise
            batch.select("file", F.lit(str(refusal)).alias("reason")).write.mode("overwrite").parquet(
                f"{out}/blocked/stamp={batch_stamp(batch)}")

    return (
        read_payload_stream(spark, source, whole_files=whole_files).writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
