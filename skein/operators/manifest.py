"""A store's manifest: which records it holds, and with what content.

One row per published version of a record, ``(cve_id, hash, version)`` under
``year=/bucket=`` like the store itself; the row with the highest version
counts. A publish compares hashes with the manifest's partitions that its
records fall in and opens no document.

Store and manifest are two tables, so a publish leaves a note before it touches
either and takes it away at the end. A note that is found was left by a publish
that was cut off: the partitions it names are read from the store once and
entered in the manifest as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import ids as I
from skein.operators.publish import with_layout
from skein.session import path_exists

MANIFEST = "cve_id string, hash string, version long, year int, bucket string"
MOST_NAMED = 2000  # partitions named one by one in a filter; beyond them a semi-join picks the rows


def folders(df: DataFrame) -> DataFrame:
    """The folder ``(year, bucket)`` of each row, of which ``df`` may name the thousand bucket."""
    return df.select("year", I.folder("bucket").alias("bucket"))


def partitions_of(df: DataFrame) -> list[tuple[int, str]] | None:
    """The distinct folders ``(year, bucket)`` of ``df``; None where they are too
    many to be named."""
    got = folders(df).distinct().limit(MOST_NAMED + 1).collect()
    return None if len(got) > MOST_NAMED else [(r["year"], r["bucket"]) for r in got]


def in_partitions(parts: list[tuple[int, str]]) -> Column:
    """A filter on partition columns only: other folders aren't listed."""
    by_year: dict = {}
    for year, bucket in parts:
        by_year.setdefault(year, []).append(bucket)
    cond = F.lit(False)
    for year, buckets in sorted(by_year.items(), key=lambda x: str(x[0])):
        y = F.col("year").isNull() if year is None else F.col("year") == year
        named = [b for b in buckets if b is not None]
        b = F.col("bucket").isin(named) if named else F.lit(False)
        cond = cond | (y & ((b | F.col("bucket").isNull()) if None in buckets else b))
    return cond


def read_partitions(df: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of a partitioned table in the partitions of ``touched``."""
    parts = partitions_of(touched)
    if parts is None:
        return df.join(folders(touched).distinct(), ["year", "bucket"], "left_semi")
    return df.filter(in_partitions(parts))


def current(manifest: DataFrame) -> DataFrame:
    """``(cve_id, hash)`` of the versions that count."""
    return manifest.groupBy("cve_id").agg(F.max_by("hash", "version").alias("hash"))


def read(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def next_version(spark: SparkSession, path: str) -> int:
    return (read(spark, path).agg(F.max("version")).first()[0] or 0) + 1


def append(rows: DataFrame, path: str, version: int) -> None:
    """Enter ``rows(cve_id, hash, year, bucket)``."""
    (rows.select("cve_id", "hash", F.lit(version).cast("long").alias("version"), "year", I.folder("bucket").alias("bucket")).hint("rebalance", "year", "bucket")
     .write.mode("append").partitionBy("year", "bucket").parquet(path))


def of_documents(docs: DataFrame, digest) -> DataFrame:
    """Manifest rows of ``docs(cve_id, value)``."""
    return with_layout(docs.select("cve_id", F.concat("cve_id", F.lit(".json")).alias("file_name"), digest("value").alias("hash"))) \
        .select("cve_id", "hash", "year", "bucket")
