"""Typed access to untrusted JSON documents with built-in expressions.

A document is parsed once into ``MAP<STRING, VARIANT>``: it keeps every
value's JSON type and the key order of the text, and (with
``spark.sql.mapKeyDedupPolicy=LAST_WIN``) lets a repeated key keep its
first position but its last value, like a Python dict.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.built import built_once
from skein.functions.text import WS_CLASS, strip

# --- fixed values -----------------------------------------------------------
# The eight keyphrase fields, in the canonical order used for output.
REQUIRED_FIELDS = ("rootcause", "weakness", "impact", "vector",
                   "attacker", "product", "version", "component")
# Only this field may hold a list without being reported as nested.
LIST_OK_FIELD = "version"
UNKNOWN = "unknown"
COMPONENT = "component"
# ---------------------------------------------------------------------------

MAP_SCHEMA = "map<string,variant>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@built_once
def strict_ok(c) -> Column:
    """Valid JSON text in the strict sense of Python ``json.loads``.

    ``from_json`` stops at the end of the first value, so the text is read
    inside two wrappers. In ``[text]`` a second value or junk shows (size !=
    1), unless the text closes the array itself; in ``[{"v":text}]`` a stray
    ``]`` is an error, and a stray ``}``, which would close that wrapper, is
    one in the first. No text closes both. Single quotes are refused.
    """
    x = _c(c)

    def one(before: str, after: str) -> Column:
        return F.size(F.from_json(F.concat(F.lit(before), x, F.lit(after)), "array<string>",
                                  {"allowSingleQuotes": "false"})) == 1
    return F.coalesce(one("[", "]") & one('[{"v":', "}]") & (strip(x) != F.lit("")), F.lit(False))


@built_once
def parse_object(c) -> Column:
    """``MAP<STRING,VARIANT>`` for a JSON object, null for any other text."""
    m = F.from_json(_c(c), MAP_SCHEMA)
    return F.map_from_entries(F.map_entries(m))


@built_once
def strict_parse(c) -> Column:
    """The one parse of a text: ``[text]`` read as an array of object maps. One
    element that is there means an object without anything after it, unless the
    text closes the array itself (``strict_parse_ok``)."""
    return F.from_json(F.concat(F.lit("["), _c(c), F.lit("]")), f"array<{MAP_SCHEMA}>", {"allowSingleQuotes": "false"})


def strict_parse_ok(parsed: Column, c) -> Column:
    """Whether the text of ``strict_parse`` is valid JSON. A text is read once
    more only where it holds a ``]``, which may have closed the array early, or
    isn't one object."""
    x = _c(c)
    whole = (F.size(parsed) == 1) & F.element_at(parsed, 1).isNotNull() & ~x.contains("]")
    return F.when(F.coalesce(whole, F.lit(False)), F.lit(True)).otherwise(strict_ok(x))


def strict_parse_object(parsed: Column) -> Column:
    """The object of ``strict_parse``, the last of a repeated key's values."""
    return F.map_from_entries(F.map_entries(F.element_at(parsed, 1)))


def repeated_fields(parsed: Column) -> Column:
    """Keys that stand more than once in the object of ``strict_parse``."""
    keys = F.map_keys(F.element_at(parsed, 1))
    return F.array_distinct(F.filter(keys, lambda k: F.size(F.filter(keys, lambda x: x == k)) > 1))


@built_once
def parse_doc(c) -> Column:
    """Object map of strictly valid JSON text, else null; parsed once."""
    both = F.transform(F.array(strict_parse(c)), lambda p: F.when(strict_parse_ok(p, c) & (F.size(p) == 1), strict_parse_object(p)))
    return F.element_at(both, 1)


def vtype(v) -> Column:
    """JSON type of a variant: STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN,
    VOID (JSON null), ARRAY<..>, OBJECT<..>."""
    return F.schema_of_variant(_c(v))


def is_str(v) -> Column:
    return vtype(v) == F.lit("STRING")


def is_nested(v) -> Column:
    t = vtype(v)
    return t.startswith("ARRAY") | t.startswith("OBJECT")


def as_str(v) -> Column:
    return F.variant_get(_c(v), "$", "string")


def as_text(v) -> Column:
    """String values as-is, any other value as compact JSON text."""
    x = _c(v)
    return F.when(x.isNull(), F.lit(None)).when(is_str(x), as_str(x)).otherwise(F.to_json(x))


def truthy(v) -> Column:
    """Python truthiness of a JSON value with strings judged after strip.

    Missing (SQL null), JSON null, false, numeric zero, empty array and
    empty object are false; a string is true when not blank.
    """
    x = _c(v)
    t = vtype(x)
    return (F.when(x.isNull(), F.lit(False))
            .when(t == "STRING", strip(as_str(x)) != F.lit(""))
            .when(t == "VOID", F.lit(False))
            .when(t == "BOOLEAN", F.variant_get(x, "$", "boolean"))
            .when(t.startswith("ARRAY") | t.startswith("OBJECT"),
                  ~F.to_json(x).isin("[]", "{}"))
            .otherwise(F.coalesce(F.try_variant_get(x, "$", "double") != F.lit(0.0),
                                  F.lit(True))))


def blank_unknown(m) -> Column:
    """String values equal to 'unknown' (any case, untrimmed) become ''."""
    empty = F.parse_json(F.lit('""'))
    return F.transform_values(
        _c(m), lambda k, v: F.when(is_str(v) & (F.lower(as_str(v)) == F.lit(UNKNOWN)), empty)
        .otherwise(v))


def required_array() -> Column:
    return F.array(*[F.lit(f) for f in REQUIRED_FIELDS])


def _content(v, blank_unknown: bool) -> Column:
    t = truthy(v)
    if blank_unknown:
        t = t & ~(is_str(v) & (F.lower(as_str(v)) == F.lit(UNKNOWN)))
    return t


def nonempty_flags(m, blank_unknown: bool = False) -> list[Column]:
    """Per required field: does it carry content. ``blank_unknown`` treats
    'unknown' strings as empty (the validator's reading)."""
    x = _c(m)
    return [_content(F.element_at(x, F.lit(f)), blank_unknown) for f in REQUIRED_FIELDS]


@built_once
def nonempty_count(m, blank_unknown: bool = False) -> Column:
    """How many of the eight fields carry content. ``m`` should be a column
    reference (a parsed map), not a parse expression: it is read 8 times."""
    flags = nonempty_flags(m, blank_unknown)
    total = flags[0].cast("int")
    for f in flags[1:]:
        total = total + f.cast("int")
    return F.when(_c(m).isNull(), F.lit(None)).otherwise(total)


def nonempty_fields(m) -> Column:
    flags = nonempty_flags(m)
    arr = F.array(*[F.when(fl, F.lit(name)) for fl, name in zip(flags, REQUIRED_FIELDS)])
    return F.filter(arr, lambda x: x.isNotNull())


@built_once
def quality(m) -> Column:
    """STRUCT<is_empty, is_single, non_empty_count, non_empty_fields, needs_retry>."""
    n = nonempty_count(m)
    return F.struct(
        (n == 0).alias("is_empty"),
        (n == 1).alias("is_single"),
        n.alias("non_empty_count"),
        nonempty_fields(m).alias("non_empty_fields"),
        (n <= 1).alias("needs_retry"),
    )


@built_once
def first_nested_key(m) -> Column:
    """First key in document order whose value is a list/object (not 'version')."""
    hits = F.filter(F.map_entries(_c(m)),
                    lambda e: (e["key"] != F.lit(LIST_OK_FIELD)) & is_nested(e["value"]))
    return F.try_element_at(hits, F.lit(1))["key"]


def extra_fields(m) -> Column:
    return F.array_sort(F.array_except(F.map_keys(_c(m)), required_array()))


def missing_fields(m) -> Column:
    return F.array_sort(F.array_except(required_array(), F.map_keys(_c(m))))


@built_once
def repair_response(c) -> Column:
    """Model text -> JSON text: as-is when strict; else, when the stripped
    text starts with '{', cut after the last '}'. Null when neither works.

    Each intermediate is bound once (``let``) so the strict check of the
    candidate does not copy the cut expression."""
    from skein.functions.text import let
    pat = r"(?s)^" + WS_CLASS + r"*(\{.*\})"

    def pick(x):
        return let(F.regexp_extract(x, pat, 1), lambda cut: let(
            F.when(strict_ok(x), x).when(cut != F.lit(""), cut),
            lambda cand: F.when(strict_ok(cand), cand)))
    return let(_c(c), pick)


def text_map_to_json(m) -> Column:
    return F.to_json(_c(m))
