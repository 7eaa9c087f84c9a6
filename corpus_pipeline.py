"""A training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns what it keeps with the
columns of documents; the last returns the token ids. ``run`` writes each
stage to the shared scratch folder and reads it as the next one's docs, so a
lost executor costs one stage's tasks and not the whole run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import decontam, langid, neardup, secrets, spbpe
from skein.llm.common import as_bytes, prepare, table
from skein.llm.queries import model_path
from skein.session import delete_path, release, scratch_path, scratch_scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (``und``: null or without a letter) go; an
    unsure one stays."""
    found = langid.detect(docs, langid.train(docs), keep=("text", "lang", "source", "n_chars"))
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id (none is
    the largest) and, of several texts with that id, the smallest text hash; a
    text without words has no group and stays. Rows that repeat an id and its
    text stay once, with the smallest (lang, source, n_chars), nulls first.
    Extra columns leave. Only texts of repeated rows are shuffled."""
    docs = docs.select(*COLUMNS)
    text_key = F.xxhash64(as_bytes("text"))
    root = scratch_path(spark, "near-dedup")
    # landed: it is read more than once, and what the search left is let go of
    found = neardup.near_duplicates(docs, text_key=text_key).where("kept").select("doc_id", "text_key", "group_key")
    found.write.parquet(f"{root}/found")
    found = spark.read.schema(found.schema).parquet(f"{root}/found")
    release(spark)
    # the kept rows of a group all have its smallest id
    first = found.where("group_key IS NOT NULL").groupBy("group_key").agg(F.min("doc_id").alias("stay_id"), F.min("text_key").alias("stay_key"))
    keep = first.select("stay_id", "stay_key").union(found.where("group_key IS NULL").select("doc_id", "text_key"))
    # landed: its size is known when the texts meet it
    counts = docs.groupBy(F.col("doc_id").cast("long").alias("id"), text_key.alias("key")).agg((F.count("*") > 1).alias("repeated")).where("repeated")
    keep.distinct().write.parquet(f"{root}/keep")
    counts.select("id", "key").write.parquet(f"{root}/repeated")
    keep = spark.read.schema("stay_id long, stay_key long").parquet(f"{root}/keep")
    repeated = spark.read.schema("id long, key long").parquet(f"{root}/repeated")
    kept = docs.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col("stay_id")) & (text_key == F.col("stay_key")), "left_semi")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (text_key == F.col("key"))
    least = kept.join(repeated, same, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*COLUMNS[2:])).alias("r"))
    return kept.join(repeated, same, "left_anti").select(*COLUMNS).unionByName(least.select("doc_id", "text", "r.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean_documents(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by their kind."""
    return secrets.redact_documents(docs.select(*COLUMNS)).select(*COLUMNS[:4], F.length("text").cast("long").alias("n_chars"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the text they decode to."""
    return spbpe.encode_documents(docs, model_path(), keep=("lang", "source")).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "decoded")


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding and decoding", tokenize),
]

# a trained network and the merge encoder are beyond SQL: tests/llm has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's own scratch tables, and the table it
    read, are deleted when it is written."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    root = scratch_path(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(f"{root}/{k}")
        if k:
            delete_path(spark, f"{root}/{k - 1}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{k}")
    return docs
