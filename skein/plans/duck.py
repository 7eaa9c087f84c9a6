"""DuckDB spellings of the column expressions, for the oracle SQL.

These mirror skein.functions in RE2 / DuckDB syntax so that the oracle is
an independent re-statement of each rule over the same parquet tables.
"""

from __future__ import annotations

from skein.fixtures import with_clause
from skein.functions.jsonx import REQUIRED_FIELDS
from skein.functions.text import KERNEL_BUG, KERNEL_PREFIX, PLACEHOLDERS

WS = r"[\t\n\x0B\f\r \x1c-\x1f\x{85}\pZ]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def blank(x: str) -> str:
    inner = f"coalesce({x}, '')"
    return f"({strip(inner)} = '')"


def strip_html(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', '', 'g')"


def strip_punct(x: str) -> str:
    return f"regexp_replace({x}, '[''\"\\n\\r:;]', '', 'g')"


def ascii_only(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x00-\\x7F]+', '', 'g')"


def collapse_ws(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def clean(x: str) -> str:
    y = ascii_only(strip_punct(strip_html(f"coalesce({x}, '')")))
    return strip(f"regexp_replace({y}, '[\\t\\n\\x0B\\f\\r \\x1c-\\x1f]+', ' ', 'g')")


def kernel(x: str) -> str:
    head = strip(f"string_split_regex({x}, '\\[\\d+\\.\\d+\\]|\\[#')[1]")
    cut = (f"CASE WHEN strpos({head}, {q(KERNEL_BUG)}) > 0 THEN "
           f"{strip(f'substr({head}, 1, strpos({head}, {q(KERNEL_BUG)}) - 1)')} ELSE {head} END")
    return f"CASE WHEN starts_with({x}, {q(KERNEL_PREFIX)}) THEN {cut} ELSE {x} END"


def rejected(state: str) -> str:
    return f"({state} IS NOT DISTINCT FROM 'REJECTED')"


def keep_valid_text(x: str) -> str:
    cond = " AND ".join(f"strpos(lower({x}), {q(p.lower())}) = 0" for p in PLACEHOLDERS)
    return f"({x} IS NOT NULL AND NOT {blank(x)} AND {cond})"


def records_to_process_sql(src: str = "f_source", store: str = "f_store") -> str:
    """CTE chain (no WITH keyword) ending in view ``rtp(cve_id, description, ord)``."""
    return f"""
rtp_fill AS (SELECT ord, cve_id, CASE WHEN {rejected('state')} AND {blank('description')}
   THEN rejected_reason ELSE description END AS description, state FROM {src}),
rtp_kept AS (SELECT * FROM rtp_fill WHERE NOT {rejected('state')} OR NOT {blank('description')}),
rtp_anti AS (SELECT * FROM rtp_kept k WHERE NOT EXISTS
   (SELECT 1 FROM {store} s WHERE s.cve_id IS NOT DISTINCT FROM k.cve_id)),
rtp_clean AS (SELECT ord, cve_id, {clean('description')} AS d0 FROM rtp_anti),
rtp_k AS (SELECT ord, cve_id, {kernel('d0')} AS description FROM rtp_clean),
rtp AS (SELECT ord, cve_id, description FROM rtp_k WHERE {keep_valid_text('description')})"""


def with_fixtures(fixtures, *ctes: str) -> str:
    """WITH clause holding the fixture views followed by extra CTEs."""
    w = with_clause(fixtures, "duckdb")
    extra = ",\n".join(c.strip() for c in ctes if c.strip())
    if not w:
        return "WITH " + extra if extra else ""
    return w + (",\n" + extra if extra else "")


FIELDS = REQUIRED_FIELDS


REQ_LIST = "[" + ", ".join(q(f) for f in FIELDS) + "]"


def jpath(field: str) -> str:
    return q('$."' + field + '"')


def truthy(doc: str, field: str, blank_unknown: bool = False) -> str:
    """Python truthiness of one field of JSON text ``doc`` (missing = false)."""
    p = jpath(field)
    s = f"json_extract_string({doc}, {p})"
    str_ok = f"{strip(s)} <> ''"
    if blank_unknown:
        str_ok += f" AND lower({s}) <> 'unknown'"
    return f"""coalesce(CASE json_type({doc}, {p})
  WHEN 'VARCHAR' THEN ({str_ok})
  WHEN 'NULL' THEN false
  WHEN 'BOOLEAN' THEN CAST(json_extract({doc}, {p}) AS BOOLEAN)
  WHEN 'ARRAY' THEN json_array_length({doc}, {p}) > 0
  WHEN 'OBJECT' THEN CAST(json_extract({doc}, {p}) AS VARCHAR) <> '{{}}'
  WHEN 'BIGINT' THEN CAST(json_extract({doc}, {p}) AS DOUBLE) <> 0
  WHEN 'UBIGINT' THEN CAST(json_extract({doc}, {p}) AS DOUBLE) <> 0
  WHEN 'DOUBLE' THEN CAST(json_extract({doc}, {p}) AS DOUBLE) <> 0
  ELSE false END, false)"""


def nonempty_count(doc: str, blank_unknown: bool = False) -> str:
    return "(" + " + ".join(f"CAST({truthy(doc, f, blank_unknown)} AS INTEGER)" for f in FIELDS) + ")"


def nonempty_fields(doc: str) -> str:
    parts = ", ".join(f"CASE WHEN {truthy(doc, f)} THEN {q(f)} END" for f in FIELDS)
    return f"array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), '|')"


def validation_cte(src: str = "f_staged") -> str:
    """CTE ``vd`` with the classification of raw docs (file_name, content)."""
    nested = (f"list_filter(json_keys(content), lambda k: k <> 'version' AND "
              f"json_type(content, '$.\"' || k || '\"') IN ('ARRAY', 'OBJECT'))[1]")
    return f"""
vd0 AS (SELECT replace(file_name, '_keyphrases.json', '') AS cve_id, file_name, content,
  CAST(strlen(content) AS BIGINT) AS size, coalesce(json_valid(content), false) AS ok FROM {src}),
vd1 AS (SELECT *, CASE WHEN NOT ok THEN 'Invalid JSON'
  WHEN json_type(content) <> 'OBJECT' THEN 'JSON must be a flat object'
  WHEN {nested} IS NOT NULL THEN 'Nested structure found in field: ' || {nested} END AS error FROM vd0),
vd2 AS (SELECT *, CASE WHEN error IS NULL THEN {nonempty_count('content', True)} END AS n,
  CASE WHEN error IS NULL THEN list_sort(list_filter(json_keys(content), lambda k: NOT list_contains({REQ_LIST}, k))) END AS extra,
  CASE WHEN error IS NULL THEN list_sort(list_filter({REQ_LIST}, lambda f: NOT list_contains(json_keys(content), f))) END AS missing
  FROM vd1),
vd AS (SELECT cve_id, file_name, size, content,
  coalesce(error IS NULL AND len(extra) = 0 AND len(missing) = 0 AND n > 1, false) AS json_valid,
  CASE WHEN error IS NULL THEN md5(content) END AS content_hash, error,
  array_to_string(extra, '|') AS extra_fields, array_to_string(missing, '|') AS missing_fields,
  coalesce(error IS NULL AND n = 0, false) AS empty_keyphrases,
  coalesce(error IS NULL AND n = 1, false) AS single_keyphrase,
  CAST(n AS BIGINT) AS non_empty_count FROM vd2)"""


P_LIST_Q = r"^\[(['\"][^'\"]*['\"](?:" + WS + r"*," + WS + r"*['\"][^'\"]*['\"])*)\]$"
P_ITEM_Q = r"['\"]([^'\"]*)['\"]"
P_LIST_DQ = r'^\["([^"]*)"(?:' + WS + r'*,' + WS + r'*"([^"]*)")*\]$'
P_ITEM_DQ = r'"([^"]*)"'


def _peel(x: str, o: str, c: str) -> str:
    return (f"CASE WHEN starts_with({x}, {q(o)}) AND ends_with({x}, {q(c)}) THEN "
            f"CASE WHEN length({x}) < 2 THEN '' ELSE {strip(f'substr({x}, 2, length({x}) - 2)')} END "
            f"ELSE {x} END")


def normalize_text_ctes(src: str, keys: str, prefix: str = "nt") -> str:
    """CTEs over ``src(keys..., s)`` ending in ``{prefix}(keys..., norm)``."""
    return f"""
{prefix}0 AS (SELECT {keys}, s, {strip('s')} AS st FROM {src}),
{prefix}1 AS (SELECT *, {_peel('st', '[', ']')} AS c1 FROM {prefix}0),
{prefix}2 AS (SELECT *, {_peel('c1', '"', '"')} AS c2 FROM {prefix}1),
{prefix}3 AS (SELECT *, {_peel('c2', "'", "'")} AS c3 FROM {prefix}2),
{prefix} AS (SELECT {keys}, CASE
  WHEN regexp_matches(st, {q(P_LIST_Q)}) THEN array_to_string(regexp_extract_all(regexp_extract(st, {q(P_LIST_Q)}, 1), {q(P_ITEM_Q)}, 1), ', ')
  WHEN regexp_matches(st, {q(P_LIST_DQ)}) THEN array_to_string(regexp_extract_all(s, {q(P_ITEM_DQ)}, 1), ', ')
  ELSE c3 END AS norm FROM {prefix}3)"""


def scalar_text(j: str) -> str:
    """Python str() of one JSON value (DuckDB JSON)."""
    return (f"CASE json_type({j}) WHEN 'VARCHAR' THEN json_extract_string({j}, '$') "
            f"WHEN 'BOOLEAN' THEN CASE WHEN CAST({j} AS BOOLEAN) THEN 'True' ELSE 'False' END "
            f"WHEN 'NULL' THEN 'None' ELSE CAST({j} AS VARCHAR) END")


def kp_text(doc: str, field: str) -> str:
    """Text of a keyphrase field after fill-required (missing -> '')."""
    p = jpath(field)
    return (f"CASE WHEN json_type({doc}, {p}) IS NULL THEN '' WHEN json_type({doc}, {p}) = 'VARCHAR' "
            f"THEN json_extract_string({doc}, {p}) ELSE CAST(json_extract({doc}, {p}) AS VARCHAR) END")


def _part(doc: str, path: str) -> str:
    return (f"CASE json_type({doc}, {path}) WHEN 'ARRAY' THEN CAST(json_extract({doc}, {path}) AS JSON[]) "
            f"WHEN 'VARCHAR' THEN CASE WHEN json_extract_string({doc}, {path}) <> '' "
            f"THEN [json_extract({doc}, {path})] ELSE CAST([] AS JSON[]) END ELSE CAST([] AS JSON[]) END")


def folded_component(doc: str) -> str:
    """Text of ``component`` after folding ``component*`` keys."""
    keypath = "'$.\"' || k || '\"'"
    found = (f"flatten(list_transform(list_filter(json_keys({doc}), lambda k: starts_with(k, 'component') "
             f"AND k <> 'component'), lambda k: {_part(doc, keypath)}))")
    allv = f"list_concat({found}, {_part(doc, q('$.component'))})"
    one = f"{allv}[1]"
    one_text = (f"CASE json_type({one}) WHEN 'VARCHAR' THEN json_extract_string({one}, '$') "
                f"ELSE CAST({one} AS VARCHAR) END")
    return (f"CASE WHEN len({found}) = 0 THEN {kp_text(doc, 'component')} "
            f"WHEN len({allv}) > 1 THEN '[' || array_to_string(list_transform({allv}, lambda x: CAST(x AS VARCHAR)), ',') || ']' "
            f"ELSE {one_text} END")


def merged_extra_keys(doc: str) -> str:
    return (f"array_to_string(list_sort(list_filter(json_keys({doc}), lambda k: NOT list_contains({REQ_LIST}, k) "
            f"AND NOT starts_with(k, 'component'))), '|')")


def merge_ctes() -> str:
    return """
kpd AS (SELECT split_part(file_name, '_', 1) AS cve_id, content, coalesce(json_valid(content), false) AS ok FROM f_staged),
kpo AS (SELECT cve_id, content FROM kpd WHERE CASE WHEN ok THEN json_type(content) = 'OBJECT' ELSE false END),
ids AS (SELECT DISTINCT cve_id FROM kpd),
env AS (SELECT cve_id FROM kpd WHERE ok
  UNION SELECT cve_id FROM f_descriptions WHERE cve_id IN (SELECT cve_id FROM ids)
  UNION SELECT cve_id FROM f_impacts WHERE cve_id IN (SELECT cve_id FROM ids))"""


def stub_json(L: str, k: str) -> str:
    """Canonical JSON answer of the stub client with the first k fields set."""
    parts = [f"'\"{f}\":\"' || CASE WHEN {i} < ({k}) THEN '{f}-' || CAST(({L}) % 97 AS VARCHAR) ELSE '' END || '\"'"
             for i, f in enumerate(FIELDS)]
    return "('{' || " + " || ',' || ".join(parts) + " || '}')"


def repaired(resp: str) -> str:
    cut = f"regexp_extract({resp}, '(?s)^{WS}*(\\{{.*\\}})', 1)"
    return (f"CASE WHEN {resp} IS NULL THEN NULL WHEN coalesce(json_valid({resp}), false) THEN {resp} "
            f"WHEN {cut} <> '' AND coalesce(json_valid({cut}), false) THEN {cut} END")
