"""Validation of staged keyphrase documents and the reports built on it.

One projection classifies each raw document (strict JSON, object root,
nested values, extra / missing fields, empty / single content); the
summaries, reports, duplicate groups and the quarantine split all read
that one classified table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import ids as I
from skein.functions import jsonx as J
from skein.operators.ingest import key_filter, with_maybe
from skein.operators.layout import balance, fence
from skein.session import scratch_path

# --- fixed values -----------------------------------------------------------
ERR_INVALID = "Invalid JSON"
ERR_NOT_OBJECT = "JSON must be a flat object"
ERR_NESTED = "Nested structure found in field: "
ISSUE_KINDS = ("error", "extra_fields", "missing_fields", "empty_keyphrases", "single_keyphrase")
# ---------------------------------------------------------------------------


def classify(docs: DataFrame, key=None, size_col: str | None = None,
             check_duplicates: bool = False) -> DataFrame:
    """Validate raw docs ``(file_name, content)``.

    Output: ``cve_id, file_name, size, json_valid, content_hash, error,
    extra_fields, missing_fields, duplicated_fields, empty_keyphrases,
    single_keyphrase, non_empty_count, content``. Zero-byte docs must be
    present as ``content = ''`` rows (file readers drop empty files).

    ``check_duplicates`` also reports keys repeated in one object (a Python
    dict cannot hold them, so this check is off by default).
    """
    key = key if key is not None else I.key_from_suffix("file_name")
    base = fence(balance(docs).select(
        key.alias("cve_id"), "file_name", "content",
        (F.col(size_col) if size_col else F.octet_length("content")).cast("bigint").alias("size"),
        J.strict_parse("content").alias("__p")))
    ok = F.coalesce(J.strict_parse_ok(F.col("__p"), "content"), F.lit(False))
    parsed = fence(base.select("cve_id", "file_name", "content", "size", "__p", ok.alias("__ok")))
    one = F.col("__ok") & (F.size("__p") == 1)
    dup = F.when(one, J.repeated_fields(F.col("__p"))) if check_duplicates else F.lit(None).cast("array<string>")
    parsed = fence(parsed.select("cve_id", "file_name", "content", "size", "__ok",
                                 F.when(one, J.strict_parse_object(F.col("__p"))).alias("__m"), dup.alias("__dup")))
    m = F.col("__m")
    nested = J.first_nested_key(m)
    error = (F.when(~F.col("__ok"), F.lit(ERR_INVALID))
             .when(m.isNull(), F.lit(ERR_NOT_OBJECT))
             .when(nested.isNotNull(), F.concat(F.lit(ERR_NESTED), nested)))
    staged = fence(parsed.select("*", error.alias("error"),
                                 J.nonempty_count(m, blank_unknown=True).alias("__n")))
    hard = F.col("error").isNotNull()
    n = F.col("__n")
    extra = F.when(~hard, J.extra_fields(m))
    missing = F.when(~hard, J.missing_fields(m))
    dup = F.when(~hard & (F.size(F.coalesce("__dup", F.array().cast("array<string>"))) > 0), F.col("__dup"))
    empty = F.coalesce(~hard & (n == 0), F.lit(False))
    single = F.coalesce(~hard & (n == 1), F.lit(False))
    valid = (~hard & (F.size(extra) == 0) & (F.size(missing) == 0) & dup.isNull() & ~empty & ~single)
    return staged.select(
        "cve_id", "file_name", "size",
        F.coalesce(valid, F.lit(False)).alias("json_valid"),
        F.when(~hard, F.md5("content")).alias("content_hash"),
        "error",
        extra.alias("extra_fields"), missing.alias("missing_fields"),
        dup.alias("duplicated_fields"),
        empty.alias("empty_keyphrases"), single.alias("single_keyphrase"),
        F.when(~hard, n).alias("non_empty_count"),
        "content")


def issue_kinds(v: DataFrame) -> DataFrame:
    """``(cve_id, kind)`` for every issue a doc has."""
    kinds = F.array(
        F.when(F.col("error").isNotNull(), F.lit("error")),
        F.when(F.size(F.coalesce("extra_fields", F.array())) > 0, F.lit("extra_fields")),
        F.when(F.size(F.coalesce("missing_fields", F.array())) > 0, F.lit("missing_fields")),
        F.when(F.size(F.coalesce("duplicated_fields", F.array())) > 0, F.lit("duplicated_fields")),
        F.when(F.col("empty_keyphrases"), F.lit("empty_keyphrases")),
        F.when(F.col("single_keyphrase"), F.lit("single_keyphrase")))
    return v.select("cve_id", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("kind"))


def issue_counts(v: DataFrame) -> DataFrame:
    return issue_kinds(v).groupBy("kind").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def validation_summary(v: DataFrame) -> DataFrame:
    """One row: total, valid, invalid, zero-byte, empty, single."""
    return v.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("json_valid").alias("valid"),
        F.count_if(~F.col("json_valid")).alias("invalid"),
        F.count_if(F.col("size") == 0).alias("zero_byte"),
        F.count_if(~F.col("json_valid") & F.col("empty_keyphrases")).alias("empty"),
        F.count_if(~F.col("json_valid") & F.col("single_keyphrase")).alias("single"),
    ).select([F.col(c).cast("bigint") for c in
              ("total", "valid", "invalid", "zero_byte", "empty", "single")])


def invalid_report(v: DataFrame) -> DataFrame:
    """Zero-byte or invalid docs, smallest first (ties by id)."""
    return (v.filter((F.col("size") == 0) | ~F.col("json_valid"))
            .select("cve_id", "size", "json_valid", "content_hash", "error")
            .orderBy("size", "cve_id"))


def report_ids(v: DataFrame) -> DataFrame:
    """Sorted id lists of the empty and single reports as ``(report, cve_id)``."""
    e = v.filter(~F.col("json_valid") & F.col("empty_keyphrases")).select(
        F.lit("empty_keyphrases").alias("report"), "cve_id")
    s = v.filter(~F.col("json_valid") & F.col("single_keyphrase")).select(
        F.lit("single_keyphrase").alias("report"), "cve_id")
    return e.unionByName(s).orderBy("report", "cve_id")


def quarantine_split(v: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): valid docs stay, the rest go to quarantine.
    Persist or write ``v`` first so both branches read one classification."""
    return v.filter("json_valid"), v.filter(~F.col("json_valid"))


def duplicate_groups(df: DataFrame, key: str, content: str | None = None, hash_col: str | None = None) -> DataFrame:
    """Rows whose content occurs more than once: ``(content_hash, key, n_copies)``.

    The texts are scanned once, for their hashes, which are landed. Counting is
    a hash aggregate with map-side partial counts, so a hash shared by a large
    share of the rows costs one row per task in the shuffle. A filter of the
    repeated hashes then goes to the landed rows: a row that occurs once is ruled
    out in place, and only the others meet the counts, in a join that AQE splits
    when one hash dominates. Members are listed one row each (no per-group
    array). ``hash_col`` takes a hash that is there already.
    """
    spark = df.sparkSession
    h = df.select(F.col(key), (F.col(hash_col) if hash_col else F.md5(F.col(content))).alias("content_hash"))
    path = scratch_path(spark, "hashes")
    h.write.parquet(f"{path}/all")
    h = spark.read.schema(h.schema).parquet(f"{path}/all")
    counts = h.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n_copies")).filter(F.col("n_copies") > 1)
    counts.write.parquet(f"{path}/repeated")
    counts = spark.read.schema(counts.schema).parquet(f"{path}/repeated")
    maybe = with_maybe(h, "content_hash", key_filter(counts, "content_hash")).filter("__maybe").drop("__maybe")
    return maybe.join(counts, "content_hash").select(
        "content_hash", key, F.col("n_copies").cast("bigint").alias("n_copies"))


def quality_table(docs: DataFrame, key=None) -> DataFrame:
    """Extractor-side quality of parsed docs (no 'unknown' blanking)."""
    key = key if key is not None else I.key_from_suffix("file_name")
    base = fence(balance(docs).select(key.alias("cve_id"), "file_name",
                                      J.parse_doc("content").alias("__m")))
    q = J.quality(F.col("__m"))
    return fence(base.filter(F.col("__m").isNotNull()).select("cve_id", "file_name", q.alias("q"))) \
        .select("cve_id", "file_name", "q.*")


def insufficient_docs(docs: DataFrame, key=None) -> DataFrame:
    """Docs whose extractor-side count is 0 or 1, with that count.

    Object roots are scored; an array root counts 0; a string root counts 0
    unless it mentions a field name (the reference then fails on it); other
    roots and invalid JSON are skipped."""
    from skein.functions.text import strip
    key = key if key is not None else I.key_from_suffix("file_name")
    base = balance(docs).select(key.alias("cve_id"), "file_name", "content",
                                J.strict_ok("content").alias("__ok"))
    first = F.substring(strip("content"), 1, 1)
    parsed = fence(base.select("*", first.alias("__first"),
                               F.when(F.col("__ok") & (first == "{"), J.parse_object("content")).alias("__m")))
    mentions = F.lit(False)
    for f in J.REQUIRED_FIELDS:
        mentions = mentions | F.col("content").contains(f)
    fc = F.col("__first")
    n = (F.when(~F.col("__ok"), F.lit(None))
         .when(fc == "{", J.nonempty_count(F.col("__m")))
         .when(fc == "[", F.lit(0))
         .when((fc == '"') & ~mentions, F.lit(0)))
    scored = fence(parsed.select("cve_id", "file_name", "content", n.alias("current_count")))
    return scored.filter(F.col("current_count") <= 1)


def missing_section(store_docs: DataFrame, base_dir: str = "") -> DataFrame:
    """Published docs (``path, content``) lacking a ``keyphrases`` object.

    Only ``<base>/<digits>/<one dir>/<name>.json`` paths are scanned.
    Invalid JSON is not listed; an object root without an object
    ``keyphrases``, an array root, and a string root not containing the
    word are listed; number / bool / null roots are not."""
    from skein.functions.text import strip
    base_dir = base_dir.rstrip("/")
    pat = "^" + base_dir.replace(".", r"\.") + r"/\d+/[^/]+/[^/]+\.json$"
    scoped = balance(store_docs.filter(F.col("path").rlike(pat)))
    ok = fence(scoped.select("path", "content", J.strict_ok("content").alias("__ok")))
    first = F.substring(strip("content"), 1, 1)
    m = F.when(F.col("__ok") & (first == "{"), J.parse_object("content"))
    kp_type = J.vtype(F.element_at(m, F.lit("keyphrases")))
    missing = (F.when(~F.col("__ok"), F.lit(False))
               .when(first == "{", ~F.coalesce(kp_type.startswith("OBJECT"), F.lit(False)))
               .when(first == "[", F.lit(True))
               .when(first == '"', ~F.col("content").contains("keyphrases"))
               .otherwise(F.lit(False)))
    flagged = fence(ok.select("path", missing.alias("__missing")))
    return flagged.filter("__missing").select("path").orderBy("path")
