"""Repair of malformed keyphrase values into plain text fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import ids as I
from skein.functions import jsonx as J
from skein.functions.text import WS_CLASS, strip
from skein.operators.layout import balance, fence  # noqa: F401

# --- fixed values -----------------------------------------------------------
# Text shaped like a list of quoted items (either quote; no space after "[")
LIST_OF_QUOTED_RE = ("^\\[(['\"][^'\"]*['\"](?:" + WS_CLASS + "*," + WS_CLASS
                     + "*['\"][^'\"]*['\"])*)\\]$")
QUOTED_ITEM_RE = "['\"]([^'\"]*)['\"]"
# Text shaped like a list of double-quoted items (items may hold ')
LIST_OF_DQ_RE = '^\\["([^"]*)"(?:' + WS_CLASS + '*,' + WS_CLASS + '*"([^"]*)")*\\]$'
DQ_ITEM_RE = '"([^"]*)"'
JOIN = ", "
# ---------------------------------------------------------------------------


def _peel(x: Column, open_: str, close: str) -> Column:
    """Strip one enclosing layer (``[..]``, ``".."``, ``'..'``) and re-strip.

    One regex replacement instead of a branch that reads ``x`` four times;
    a lone quote character counts as both ends and becomes ''."""
    o, c = "\\" + open_, "\\" + close
    pat = f"(?s)^{o}(.*){c}$" + (f"|^{o}$" if open_ == close else "")
    return strip(F.regexp_replace(x, pat, "$1"))


def normalize_text(c) -> Column:
    """Malformed text value -> plain text (list-shaped text joined by ', ',
    else one layer each of brackets, double and single quotes removed)."""
    s = c if isinstance(c, Column) else F.col(c)
    st = strip(s)
    p1 = F.array_join(F.regexp_extract_all(F.regexp_extract(st, LIST_OF_QUOTED_RE, 1),
                                           F.lit(QUOTED_ITEM_RE), 1), JOIN)
    p2 = F.array_join(F.regexp_extract_all(s, F.lit(DQ_ITEM_RE), 1), JOIN)
    peeled = _peel(_peel(_peel(st, "[", "]"), '"', '"'), "'", "'")
    return (F.when(st.rlike(LIST_OF_QUOTED_RE), p1)
            .when(st.rlike(LIST_OF_DQ_RE), p2)
            .otherwise(peeled))


def _scalar_text(x: Column) -> Column:
    """Python ``str()`` of a scalar JSON value (floats in Spark spelling)."""
    t = J.vtype(x)
    return (F.when(t == "STRING", J.as_str(x))
            .when(t == "BOOLEAN", F.when(F.variant_get(x, "$", "boolean"), F.lit("True"))
                  .otherwise(F.lit("False")))
            .when(t == "VOID", F.lit("None"))
            .otherwise(F.to_json(x)))


def _is_scalar_kept(x: Column) -> Column:
    """str / int / float / bool items survive inside a nested list."""
    t = J.vtype(x)
    return ~(t == "VOID") & ~t.startswith("ARRAY") & ~t.startswith("OBJECT")


def list_text(v) -> Column:
    """A JSON list -> items as text joined by ', '; one nested level is
    flattened keeping only scalars; other items (objects) as JSON text."""
    items = F.variant_get(v, "$", "array<variant>")

    def item(x):
        t = J.vtype(x)
        nested = F.transform(F.filter(F.variant_get(x, "$", "array<variant>"), _is_scalar_kept),
                             _scalar_text)
        return F.when(t.startswith("ARRAY"), nested).otherwise(F.array(_scalar_text(x)))
    return F.array_join(F.flatten(F.transform(items, item)), JOIN)


def normalize_value(v) -> Column:
    """Any JSON value (or a missing one) -> plain text."""
    x = v if isinstance(v, Column) else F.col(v)
    t = J.vtype(x)
    return (F.when(x.isNull() | (t == "VOID"), F.lit(""))
            .when(t == "STRING", normalize_text(J.as_str(x)))
            .when(t.startswith("ARRAY"), list_text(x))
            .otherwise(_scalar_text(x)))


def repair_records(docs: DataFrame, key=None) -> DataFrame:
    """Raw docs ``(file_name, content)`` -> ``cve_id, file_name, status,
    fixed`` where ``fixed`` is a MAP<STRING,STRING> holding the eight
    fields in canonical order followed by any extra fields (doc order),
    all as text; status is ``failed`` for invalid JSON or a non-object."""
    key = key if key is not None else I.key_from_suffix("file_name")
    parsed = fence(balance(docs).select(key.alias("cve_id"), "file_name",
                                        J.parse_doc("content").alias("__m")))
    m = F.col("__m")
    req = F.map_from_arrays(J.required_array(),
                            F.array(*[normalize_value(F.element_at(m, F.lit(f)))
                                      for f in J.REQUIRED_FIELDS]))
    extra = F.transform_values(
        F.map_filter(m, lambda k, v: ~F.array_contains(J.required_array(), k)),
        lambda k, v: normalize_value(v))
    fixed = F.when(m.isNotNull(), F.map_concat(req, extra))
    return parsed.select("cve_id", "file_name",
                         F.when(m.isNotNull(), F.lit("fixed")).otherwise(F.lit("failed")).alias("status"),
                         fixed.alias("fixed"))


def repair_stats(repaired: DataFrame) -> DataFrame:
    """processed, fixed, failed and success rate in percent (1 decimal)."""
    agg = repaired.agg(F.count(F.lit(1)).alias("processed"),
                       F.count_if(F.col("status") == "fixed").alias("fixed"),
                       F.count_if(F.col("status") == "failed").alias("failed"))
    rate = F.when(F.col("processed") > 0,
                  F.round(F.lit(100.0) * F.col("fixed") / F.col("processed"), 1))
    return agg.select(F.col("processed").cast("bigint"), F.col("fixed").cast("bigint"),
                      F.col("failed").cast("bigint"), rate.alias("success_rate"))


def copy_back(staged: DataFrame, repaired: DataFrame, key: str = "file_name") -> DataFrame:
    """Staged docs with repaired ones written over them (keyed overwrite):
    one full outer join on the file name; repaired content wins."""
    r = repaired.filter(F.col("status") == "fixed").select(
        F.col(key).alias("__k"), F.to_json("fixed").alias("__fixed"))
    s = staged.select(F.col(key).alias("__s"), F.col("content").alias("__old"))
    j = s.join(r, s["__s"] == r["__k"], "full_outer")
    return j.select(F.coalesce("__k", "__s").alias(key),
                    F.coalesce("__fixed", "__old").alias("content"),
                    F.col("__fixed").isNotNull().alias("replaced"))
