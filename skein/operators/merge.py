"""Keyed merge of description, keyphrase and technical-impact sources.

All three sources are tagged, unioned and grouped once on the id: one
shuffle builds the envelope, applies the "only ids that have a keyphrase
file" rule (a semi-join folded into the same aggregate) and carries the
impact texts for the consistency check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import jsonx as J
from skein.operators.layout import balance, fence

COMPONENT = J.COMPONENT


def _is_prefixed(k: Column) -> Column:
    return k.startswith(COMPONENT) & (k != F.lit(COMPONENT))


def fold_prefixed_fields(m) -> Column:
    """Fold ``component*`` keys into ``component``.

    Values of the prefixed keys in document order (lists spliced, other
    non-empty strings kept), then the existing ``component`` (list spliced
    or non-empty string); nothing found -> keys dropped, ``component`` left
    as is; one value -> scalar; more -> list. Prefixed keys never survive.
    """
    m = m if isinstance(m, Column) else F.col(m)

    def part(v):
        t = J.vtype(v)
        return (F.when(t.startswith("ARRAY"), F.variant_get(v, "$", "array<variant>"))
                .when((t == "STRING") & (J.as_str(v) != F.lit("")), F.array(v))
                .otherwise(F.array().cast("array<variant>")))
    prefixed = F.map_filter(m, lambda k, v: _is_prefixed(k))
    found = F.flatten(F.transform(F.map_values(prefixed), part))
    existing = F.element_at(m, F.lit(COMPONENT))
    existing_part = F.when(existing.isNull(), F.array().cast("array<variant>")).otherwise(part(existing))
    all_vals = F.concat(found, existing_part)
    folded = F.when(F.size(all_vals) > 1, F.to_variant_object(all_vals)).otherwise(all_vals.getItem(0))
    kept = F.map_filter(m, lambda k, v: ~_is_prefixed(k))
    return F.when(F.size(found) > 0,
                  F.map_concat(kept, F.create_map(F.lit(COMPONENT), folded))).otherwise(kept)


def fill_required(m) -> Column:
    """Missing required fields are added as '' (canonical order, at the end)."""
    m = m if isinstance(m, Column) else F.col(m)
    missing = F.filter(J.required_array(), lambda k: ~F.array_contains(F.map_keys(m), k))
    empties = F.transform(missing, lambda k: F.parse_json(F.lit('""')))
    return F.map_concat(m, F.map_from_arrays(missing, empties))


def normalize_keyphrases(m) -> Column:
    return fill_required(fold_prefixed_fields(m))


def _state(docs: DataFrame) -> list:
    """``parsed`` (the file makes an envelope) and ``doc_error`` of a source;
    a source without these columns holds parsed docs only."""
    return [F.col(c) if c in docs.columns else F.lit(v).alias(c) for c, v in (("parsed", True), ("doc_error", False))]


def parse_descriptions(docs: DataFrame) -> DataFrame:
    """Raw description docs ``(cve_id, content)`` for ``merge_records``:
    another root than an object makes an envelope and an error."""
    p = fence(docs.select("cve_id", J.strict_ok("content").alias("parsed"), J.parse_doc("content").alias("__m")))
    return p.select("cve_id", "parsed", F.col("__m").isNull().alias("doc_error"),
                    F.when(F.col("__m").isNotNull(), F.coalesce(J.as_text(F.element_at("__m", F.lit("description"))), F.lit(""))).alias("description"))


def parse_impacts(docs: DataFrame) -> DataFrame:
    """Raw technical-impact docs ``(cve_id, content)`` for ``merge_records``.
    A list root holds neither field and is no error; a number or literal is."""
    p = fence(docs.select("cve_id", J.strict_ok("content").alias("parsed"), J.parse_doc("content").alias("__m"),
                          F.substring(F.ltrim("content"), 1, 1).alias("__first")))
    texts, mitre = (F.element_at("__m", F.lit(k)) for k in ("impact_texts", "mitre_technical_impacts"))
    return p.select("cve_id", "parsed", (~F.col("parsed") | (F.col("__m").isNull() & ~F.col("__first").isin("[", '"'))).alias("doc_error"),
                    F.when(J.vtype(texts).startswith("ARRAY"), F.transform(F.variant_get(texts, "$", "array<variant>"), J.as_text)).alias("impact_texts"),
                    F.when(J.vtype(mitre).startswith("ARRAY"), F.variant_get(mitre, "$", "array<variant>")).alias("mitre_technical_impacts"))


def merge_records(kp_docs: DataFrame, descriptions: DataFrame | None = None,
                  impacts: DataFrame | None = None, version: str = "1.0.0",
                  run_ts: str | None = None) -> DataFrame:
    """Merged record per id having a keyphrase file.

    ``kp_docs (cve_id, content)``: raw keyphrase docs (every file counts
    for the id set; invalid JSON counts as an error and adds nothing; a
    non-object root creates the envelope without keyphrases).
    ``descriptions (cve_id, description)`` and ``impacts (cve_id,
    impact_texts[, mitre_technical_impacts])``: parsed sources.

    Output: ``cve_id, version, timestamp, description, keyphrases
    (MAP<STRING,VARIANT>), mitre_technical_impacts, impact_texts`` plus
    ``kp_error`` (the id's keyphrase file failed) for the statistics.
    """
    k = fence(balance(kp_docs).select(
        "cve_id", F.md5("content").alias("tie"), J.strict_ok("content").alias("__ok"),
        F.when(J.strict_ok("content"), J.parse_object("content")).alias("__m")))
    kp = k.select(
        "cve_id", F.lit(1).alias("src"), "tie",
        F.col("__ok").alias("parsed"),
        F.when(F.col("__m").isNotNull(), normalize_keyphrases("__m")).alias("keyphrases"),
        (~F.col("__ok") | F.col("__m").isNull()).alias("kp_error"))
    parts = [kp]
    if descriptions is not None:
        parts.append(descriptions.select("cve_id", F.lit(2).alias("src"), F.md5("description").alias("tie"), *_state(descriptions),
                                         F.coalesce("description", F.lit("")).alias("description")))
    if impacts is not None:
        cols = ["cve_id", F.lit(3).alias("src"), F.md5(F.array_join("impact_texts", "|")).alias("tie"), *_state(impacts), "impact_texts"]
        if "mitre_technical_impacts" in impacts.columns:
            cols.append("mitre_technical_impacts")
        parts.append(impacts.select(*cols))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    for c, t in (("description", "string"), ("impact_texts", "array<string>"),
                 ("mitre_technical_impacts", "array<variant>")):
        if c not in u.columns:
            u = u.withColumn(c, F.lit(None).cast(t))

    def pick(c, cond):  # of several docs of an id the same one in every run
        return F.max_by(c, F.when(cond, F.coalesce("tie", F.lit("")))).alias(c)

    g = u.groupBy("cve_id").agg(
        F.max((F.col("src") == 1).cast("int")).alias("__has_kp_file"),
        F.max(F.col("parsed").cast("int")).alias("__envelope"),
        pick("keyphrases", F.col("keyphrases").isNotNull()),
        pick("description", (F.col("src") == 2) & ~F.coalesce("doc_error", F.lit(False))),
        pick("impact_texts", F.col("impact_texts").isNotNull()),
        pick("mitre_technical_impacts", F.col("mitre_technical_impacts").isNotNull()),
        F.count_if((F.col("src") != 1) & F.col("doc_error")).alias("doc_errors"),
        F.count_if((F.col("src") == 1) & F.col("kp_error")).alias("kp_errors"),
        F.count_if(F.col("src") != 1).alias("other_files"))
    ts = F.lit(run_ts) if run_ts is not None else F.lit(None).cast("string")
    return g.select(
        "cve_id", F.lit(version).alias("version"), ts.alias("timestamp"), "description", "keyphrases",
        "mitre_technical_impacts", "impact_texts",
        (F.col("__has_kp_file") == 1).alias("has_keyphrase_file"),
        (F.col("__envelope") == 1).alias("envelope"), "kp_errors", "doc_errors", "other_files")


def merged(g: DataFrame) -> DataFrame:
    """Envelopes only: ids with a keyphrase file and at least one parsed doc."""
    return g.filter(F.col("has_keyphrase_file") & F.col("envelope")).drop(
        "has_keyphrase_file", "envelope", "kp_errors", "doc_errors", "other_files")


def merge_stats(g: DataFrame) -> DataFrame:
    """processed (envelopes), skipped (non-keyphrase files of ids without a
    keyphrase file), errors (files of the other ids that failed to parse)."""
    return g.agg(
        F.count_if(F.col("has_keyphrase_file") & F.col("envelope")).cast("bigint").alias("processed"),
        F.sum(F.when(~F.col("has_keyphrase_file"), F.col("other_files")).otherwise(0))
        .cast("bigint").alias("skipped_no_keyphrases"),
        F.sum(F.col("kp_errors") + F.when(F.col("has_keyphrase_file"), F.col("doc_errors")).otherwise(0)).cast("bigint").alias("errors"))


def semi_with_keyphrases(docs: DataFrame, kp_docs: DataFrame, key: str = "cve_id") -> DataFrame:
    """Rows of a source whose id has a keyphrase file (left semi-join)."""
    ids = kp_docs.select(key).distinct()
    return docs.join(ids, key, "left_semi")


def _impact_list(v: Column) -> Column:
    t = J.vtype(v)
    items = F.transform(F.variant_get(v, "$", "array<variant>"), J.as_text)
    return (F.when(t == "STRING", F.array(J.as_str(v)))
            .when(t.startswith("ARRAY"), items)
            .otherwise(F.array().cast("array<string>")))


def impact_mismatch(m: DataFrame) -> DataFrame:
    """Impact consistency: non-empty values of ``keyphrases.impact`` (string
    or list) vs ``impact_texts``; one row per direction that differs:
    ``(cve_id, direction, values)`` with sorted distinct values. Checked only
    when both sides exist."""
    both = m.filter(F.col("keyphrases").isNotNull() & F.col("impact_texts").isNotNull())
    kp = F.filter(_impact_list(F.element_at("keyphrases", F.lit("impact"))),
                  lambda x: x.isNotNull() & (x != ""))
    it = F.filter("impact_texts", lambda x: x.isNotNull() & (x != ""))
    d = both.select("cve_id", F.array_except(kp, it).alias("a"), F.array_except(it, kp).alias("b"))
    rows = F.array(
        F.when(F.size("a") > 0, F.struct(F.lit("keyphrases_only").alias("direction"),
                                         F.array_sort("a").alias("values"))),
        F.when(F.size("b") > 0, F.struct(F.lit("impact_texts_only").alias("direction"),
                                         F.array_sort("b").alias("values"))))
    return d.select("cve_id", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select(
        "cve_id", "r.direction", "r.values")


def record_json(m: DataFrame) -> DataFrame:
    """Serialised record: camelCase keys; absent parts omitted."""
    rec = F.struct(F.col("cve_id").alias("cveId"), "version", "timestamp", "description",
                   "keyphrases", F.col("mitre_technical_impacts").alias("mitreTechnicalImpacts"))
    return m.select("cve_id", F.to_json(rec).alias("json"))


def union_runs(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Row-level union of outcomes across runs (columns may differ)."""
    return previous.unionByName(current, allowMissingColumns=True)
