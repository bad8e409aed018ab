"""File level facts: fingerprints, inventory, inspected JSON files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltledger import settings as S
from voltledger.operators.scan import document_summary, scan_documents
from voltledger.session import ship_package
from voltledger.sources import versions

# Up to this size a file is hashed as one value; larger ones are streamed.
INLINE_BYTES = 64 * 1024 * 1024
CHUNK_BYTES = 8 * 1024 * 1024


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, modified) without reading any content; of versioned tables the current files."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .load([path, *versions.current_folders(spark, path)])
        .select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    )


def _streamed_sha256(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        digests = []
        for path in batch["file"]:
            uri = quote(path if "://" in path else path.replace("file:", "file://", 1), safe="/:@")
            system, inner = fs.FileSystem.from_uri(uri)
            digest = hashlib.sha256()
            with system.open_input_stream(inner) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


def fingerprints(spark: SparkSession, path: str, inline_bytes: int = INLINE_BYTES) -> DataFrame:
    """(file, bytes, sha256) of every file below ``path``."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    small = files.where(F.col("length") <= inline_bytes).select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )
    large = list_files(spark, path).where(F.col("bytes") > inline_bytes).select("file", "bytes")
    return small.unionByName(large.mapInPandas(_streamed_sha256, "file string, bytes long, sha256 string"))


def _plain_path(column: str) -> Column:
    """Readers write a local file's scheme as file:/ or file:///; the path is compared without it."""
    return F.regexp_replace(column, "^file:/+", "/")


def scan_json_files(
    spark: SparkSession, path: str, max_depth: int = S.SCAN_MAX_DEPTH, lines: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Threats in JSON files, and one line per file: strings checked, clean, fingerprint, time of the scan.

    A file is one document, or one document per line with ``lines``; then a large file is split between tasks
    and only its counts meet again.  Blank lines are no documents, and readers
    do not list empty files.

    No malware scanner is part of this library, so files are reported as not verified
    in that respect, never as clean.
    """
    if lines:
        documents = (
            spark.read.option("recursiveFileLookup", True).text(path).where(F.trim("value") != "")
            # This path is percent-encoded; a plus sign in it is one.
            .select(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("file"),
                    F.make_valid_utf8("value").alias("json"))
        )
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        documents = files.select(
            F.col("path").alias("file"), F.make_valid_utf8(F.col("content").cast("string")).alias("json"))
    threats = scan_documents(documents, ["file"], "json", max_depth)
    checked = document_summary(documents, ["file"], "json", max_depth).withColumnRenamed("file", "_file")
    prints = fingerprints(spark, path)
    report = prints.join(checked, _plain_path("file") == _plain_path("_file"), "left").select(
        "file", "sha256",
        F.coalesce("strings_checked", F.lit(0)).alias("strings_checked"),
        F.coalesce("threats", F.lit(0)).alias("threats"),
        F.coalesce("clean", F.lit(True)).alias("clean"),
        F.lit(False).alias("malware_scanner_available"),
        F.current_timestamp().alias("scanned_at"),
    )
    return threats, report


def inventory(spark: SparkSession, layers: Mapping[str, str], fresh_minutes: int = 30) -> DataFrame:
    """Files, bytes, newest change and recently changed files per layer."""
    out = None
    for layer, path in layers.items():
        files = list_files(spark, path).select(F.lit(layer).alias("layer"), "bytes", "modified")
        out = files if out is None else out.unionByName(files)
    recent = F.col("modified") >= F.current_timestamp() - F.expr(f"INTERVAL {int(fresh_minutes)} MINUTES")
    return out.groupBy("layer").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"),
        F.max("modified").alias("newest"), F.count_if(recent).alias("fresh_files"),
    )
