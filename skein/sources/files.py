"""Readers for the pipeline's inputs: delimited source records, published
JSON stores and staged JSON documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import ids as I
from skein.session import path_exists
from skein.sources.quoted import read_quoted

# --- fixed values -----------------------------------------------------------
# Field texts a pandas CSV reader turns into missing values by default.
NA_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
            "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
            "n/a", "nan", "null")
# Column-name patterns, tried pattern by pattern (pattern order beats column order).
ID_PATTERNS = ("cve", "cveid", "cve_id", "id", "identifier")
TEXT_PATTERNS = ("description", "desc", "summary", "text", "details")
ID_PREFIX = "CVE-"
OPTIONAL_COLUMNS = ("state", "rejected_reason")
LEGACY_COLUMNS = ("CVE", "Description")
SAMPLE_ROWS = 100
SAMPLE_VALUES = 10
# ---------------------------------------------------------------------------

ORDER = "ord"


def _na_to_null(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.when(F.col(c).isin(*NA_WORDS), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


# multiline: fields may hold newlines, and a file is read by many tasks all the same
SPLIT = "split"


def _quoting(profile: str) -> dict[str, str]:
    return {"quote": '"', "escape": "\\" if profile == "legacy" else '"', "mode": "PERMISSIVE"}


def csv_reader(spark: SparkSession, profile: str = "standard", multiline: bool | str = True):
    """``standard``: RFC-4180 quoting (doubled quotes), quoted newlines kept.
    ``legacy``: every field quoted, backslash escapes. Spark's own reader can't
    split a file whose fields may hold newlines; where they hold none,
    ``multiline=False`` lets it read a plain file in many tasks, and
    ``multiline=SPLIT`` does so with newlines (``read_csv_table``)."""
    return spark.read.option("header", True).option("multiLine", bool(multiline)).options(**_quoting(profile))


def read_csv_table(spark: SparkSession, path: str, profile: str = "standard", multiline: bool | str = True) -> DataFrame:
    """All columns as strings, pandas NA words as null, plus ``ord``: the
    source order (file path, then row position within the file).

    ``ord`` is taken right after the scan, before any shuffle, where
    ``monotonically_increasing_id`` is stable; a gzip file is one split, so
    callers spread the rows afterwards (``balance``). With ``multiline=SPLIT``
    the byte ranges of a file are read by many tasks (``quoted``); ``row`` is
    then the place in the file."""
    raw = csv_reader(spark, profile, multiline).csv(path)
    cols = raw.columns
    if multiline == SPLIT:
        t = read_quoted(spark, path, cols, _quoting(profile), profile)
        return _na_to_null(t.select(*[F.col(f"`{c}`") for c in cols], F.struct("file", "row").alias(ORDER)), cols)
    with_ord = raw.select("*", F.struct(F.col("_metadata.file_path").alias("file"),
                                        F.monotonically_increasing_id().alias("row")).alias(ORDER))
    return _na_to_null(with_ord, cols)


def by_name(columns, patterns) -> str | None:
    """First column containing the first matching pattern, case-insensitive."""
    for p in patterns:
        for c in columns:
            if p.lower() in c.lower():
                return c
    return None


def column_stats(df: DataFrame, order: str = ORDER, sample: int | None = SAMPLE_ROWS) -> DataFrame:
    """One row per string column of the first ``sample`` rows (by ``order``):
    ``column, position, has_id_prefix`` (any of the first 10 non-null
    values starts with the id prefix), ``mean_len`` (missing counted as the
    3-character text 'nan'), ``numeric`` (every non-null value is a number).

    One bounded aggregate (``sample`` rows); ``sample=None`` scans all rows
    with partial aggregation."""
    cols = [f.name for f in df.schema.fields
            if f.name != order and f.dataType.simpleString() == "string"]
    src = df.orderBy(order).limit(sample) if sample else df
    aggs = []
    for i, c in enumerate(cols):
        vals = F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v"))))
        first10 = F.slice(F.array_sort(vals), 1, SAMPLE_VALUES)
        if sample:
            has_prefix = F.exists(first10, lambda x: x["v"].startswith(ID_PREFIX))
        else:  # the first values of the whole frame, ten rows a column
            top = df.filter(F.col(c).isNotNull()).orderBy(order).limit(SAMPLE_VALUES)
            has_prefix = F.lit(not top.filter(F.col(c).startswith(ID_PREFIX)).isEmpty())
        aggs += [has_prefix.alias(f"p{i}"),
                 F.avg(F.length(F.coalesce(F.col(c), F.lit("nan")))).alias(f"m{i}"),
                 F.bool_and(F.col(c).isNull() | F.col(c).try_cast("double").isNotNull()).alias(f"n{i}")]
    row = src.agg(*aggs)
    parts = [row.select(F.lit(c).alias("column"), F.lit(i).alias("position"),
                        F.col(f"p{i}").alias("has_id_prefix"), F.col(f"m{i}").alias("mean_len"),
                        F.coalesce(F.col(f"n{i}"), F.lit(False)).alias("numeric"))
             for i, c in enumerate(cols)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def detect_columns(df: DataFrame, order: str = ORDER, sample: int | None = SAMPLE_ROWS) -> tuple[str, str]:
    """(id column, text column): by name first, else by values (id prefix in
    the first values; longest mean text among non-numeric columns, first
    on ties). Raises when either is not found."""
    cols = [c for c in df.columns if c != order]
    id_col, text_col = by_name(cols, ID_PATTERNS), by_name(cols, TEXT_PATTERNS)
    if id_col is None or text_col is None:
        stats = column_stats(df, order, sample).collect()  # one row per column
        if id_col is None:
            id_col = next((r["column"] for r in sorted(stats, key=lambda r: r["position"])
                           if r["has_id_prefix"]), None)
        if text_col is None:
            cand = [r for r in stats if not r["numeric"] and r["column"] != id_col]
            if cand:
                text_col = max(cand, key=lambda r: (r["mean_len"] or 0.0, -r["position"]))["column"]
    if not id_col or not text_col:
        raise ValueError(f"cannot detect id and text columns among {cols}")
    return id_col, text_col


def read_csv_records(spark: SparkSession, path: str, profile: str | None = None, multiline: bool | str = True) -> DataFrame:
    """Source records ``(cve_id, description[, state, rejected_reason], ord)``.

    The standard profile with column detection is tried first; when reading
    or detection fails the legacy profile with fixed columns is used."""
    if profile != "legacy":
        try:
            t = read_csv_table(spark, path, "standard", multiline)
            id_col, text_col = detect_columns(t)
            extra = [c for c in OPTIONAL_COLUMNS if c in t.columns]
            return t.select(F.col(id_col).alias("cve_id"), F.col(text_col).alias("description"),
                            *extra, ORDER)
        except (ValueError, AnalysisException):
            if profile == "standard":
                raise
    t = read_csv_table(spark, path, "legacy", multiline)
    return t.select(F.col(LEGACY_COLUMNS[0]).alias("cve_id"),
                    F.col(LEGACY_COLUMNS[1]).alias("description"), ORDER)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, RFC-4180 quoting, surrounding spaces preserved."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def read_json_store(spark: SparkSession, path: str, legacy: bool = False, schema=None) -> DataFrame:
    """Published records. Our store is JSON lines under ``year=/bucket=``
    partitions. ``legacy=True`` reads a tree of one pretty-printed
    ``CVE-*.json`` doc per file (recursive, name-filtered), adds
    ``source_file`` and drops unreadable docs."""
    if not legacy:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.json(path)
    r = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "CVE-*.json")
         .option("multiLine", True).option("mode", "DROPMALFORMED"))
    if schema is not None:
        r = r.schema(schema)
    return r.json(path).withColumn("source_file", F.col("_metadata.file_name"))


def scan_docs(spark: SparkSession, path: str, glob: str = "*_keyphrases.json",
              recursive: bool = False) -> DataFrame:
    """Raw docs ``(file_name, file_path, size, content)`` with their exact
    text (for hashing). Spark's file readers skip zero-byte files; feed
    those through a manifest table (``with_manifest``) when they matter."""
    r = spark.read.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = r.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_size").alias("size"),
                     F.col("value").alias("content"))


def read_stage_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Raw docs ``(cve_id, file_name, content)`` of one stage folder
    (description, keyphrases or technical_impacts); an absent folder is an
    empty source."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "cve_id string, file_name string, content string")
    return scan_docs(spark, folder, glob="CVE-*_*.json").select(I.key_from_split("file_name").alias("cve_id"), "file_name", "content")


def with_manifest(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add manifest entries (``file_name, size``) missing from the scan as
    ``content = ''`` rows, so zero-byte docs are validated too."""
    missing = manifest.join(docs.select("file_name"), "file_name", "left_anti")
    return docs.unionByName(missing.select("file_name", F.lit(None).cast("string").alias("file_path"),
                                           F.col("size").cast("bigint"), F.lit("").alias("content")),
                            allowMissingColumns=True)


def scan_store_paths(spark: SparkSession, base: str) -> DataFrame:
    """Docs ``(path, content)`` of a store tree of one doc a file. Paths start
    below ``base``, as ``missing_section`` takes them; it scopes them to
    ``/<digits>/<dir>/*.json``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = fs.makeQualified(p).toUri().getRawPath().rstrip("/")
    docs = scan_docs(spark, base, glob="*.json", recursive=True)
    path = F.regexp_replace("file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return docs.select(path.substr(F.lit(len(root) + 1), F.length(path)).alias("path"), "content")
