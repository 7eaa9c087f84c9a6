"""Incremental runs over a growing source folder (Structured Streaming).

A file stream with ``trigger(availableNow=True)`` picks up only files not
seen by earlier runs (the checkpoint remembers them) and stops when caught
up. Each micro-batch prepares its records and appends to the sink only ids
the sink does not hold yet, so an id is emitted once across runs and a
replayed batch adds nothing. The state is the sink itself, not an
unbounded ``dropDuplicates`` store. The sink is laid out by the ids' year and
bucket folder, which makes its folders an index: a micro-batch lists and
opens only the files that may hold its ids, however large the sink has grown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from skein.functions import ids as I
from skein.operators import ingest, manifest
from skein.session import path_exists

SOURCE_SCHEMA = StructType([
    StructField("ord", LongType()), StructField("cve_id", StringType()),
    StructField("description", StringType()), StructField("state", StringType()),
    StructField("rejected_reason", StringType())])
SINK_SCHEMA = "cve_id string, ord long, description string, year int, bucket string"


def by_id(df: DataFrame) -> DataFrame:
    """Add the sink's partition of each id: its year and bucket folder, both
    null for an id of another form and for none."""
    name = F.concat("cve_id", F.lit(".json"))
    usual = I.publish_name_ok(name)
    return df.select("*", F.when(usual, I.id_year(name)).alias("year"), F.when(usual, I.folder(I.bucket(I.id_number(name)))).alias("bucket"))


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.schema(SINK_SCHEMA).parquet(sink)


def seen_ids(spark: SparkSession, sink: str, batch: DataFrame) -> DataFrame | None:
    """Sink ids that also occur in ``batch(cve_id, year, bucket)`` (null-safe).

    The batch's partitions are named in a filter, so only their files are
    opened. The ids in them are semi-joined against the batch ids: when the
    batch side is under the broadcast threshold (Catalyst measures it) the
    sink's ids are not shuffled, and the later anti-join only sees this small
    hit set. A large batch falls back to a sort-merge semi-join."""
    if not path_exists(spark, sink):
        return None
    ids = manifest.read_partitions(read_sink(spark, sink), batch).select("cve_id")
    b = batch.select(F.col("cve_id").alias("__b"))
    return ids.join(b, ids["cve_id"].eqNullSafe(b["__b"]), "left_semi")


def process_batch(batch: DataFrame, store: DataFrame | None, sink: str) -> None:
    """Prepare one micro-batch and append new ids (first row per id)."""
    spark = batch.sparkSession
    batch = batch.persist()  # read for the batch's partitions, for its ids and for its rows
    try:
        todo = ingest.records_to_process(batch, store)
        first = ingest.first_wins(todo.select("cve_id", "ord", "description"), "cve_id", "ord")
        new = ingest.incremental_anti(first, seen_ids(spark, sink, by_id(batch.select("cve_id"))))
        by_id(new.select("cve_id", "ord", "description")).hint("rebalance", "year", "bucket") \
            .write.mode("append").partitionBy("year", "bucket").parquet(sink)
    finally:
        batch.unpersist()


def run_incremental(spark: SparkSession, source_dir: str, sink: str, checkpoint: str,
                    store: DataFrame | None = None, files_per_batch: int | None = None,
                    fmt: str = "parquet", schema: StructType = SOURCE_SCHEMA) -> DataFrame:
    """Process every source file not yet seen, then stop; returns the sink."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(source_dir)
    q = (stream.writeStream
         .foreachBatch(lambda df, epoch: process_batch(df, store, sink))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return read_sink(spark, sink).drop("year", "bucket")
