"""Derived fixture views over the driver tables (see FIXTURES.md).

Each view is one SQL statement that Spark and DuckDB both run, so the
Spark operators and the DuckDB oracle read identical inputs. ``{S}`` is the
string type, ``{A}`` the array constructor and ``{X}`` the array-to-rows
function of the dialect. Subsets (the published store, the target
folder, second copies, missing sources) are chosen by data of the driver
tables (``labels`` membership, ``lang``), never by id arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

# Record ids from doc_id: numbers of 4 to 7 digits whatever the table's size;
# past each _CYCLE the years go on, so ids stay distinct up to the end of the
# id format itself (four-digit years, about 3e9 documents).
_CYCLE = 9990027
_YEAR = f"CAST(1999 + doc_id % 27 + 27 * CAST(floor(doc_id / {_CYCLE}) AS BIGINT) AS {{S}})"
_NUMBER = f"(1000 + (doc_id * 37) % {_CYCLE})"
_CVE = f"'CVE-' || {_YEAR} || '-' || CAST({_NUMBER} AS {{S}})"
CVE_SQL = _CVE


def _json_text(x: str) -> str:
    """A text as the inside of a JSON string, in both dialects."""
    for c, e in ((92, "chr(92)"), (34, "chr(34)"), (10, "'n'"), (13, "'r'"), (9, "'t'")):
        x = f"replace({x}, chr({c}), chr(92) || {e})"
    return x


_TEXT = _json_text("coalesce(text, '')")

FIXTURE_SQL: dict[str, str] = {
    "f_source": """
SELECT doc_id AS ord,
 CASE WHEN doc_id % 97 = 0 THEN NULL ELSE """ + _CVE + """ END AS cve_id,
 CASE WHEN doc_id % 20 = 0 THEN ' '
  WHEN doc_id % 23 = 0 THEN 'In the Linux kernel, the following vulnerability has been resolved: ' || text || ' [12.345] trace BUG: kernel oops'
  WHEN doc_id % 29 = 0 THEN '** REJECT ** Do not use this candidate number. ConsultIDs: none. Reason: This candidate is a duplicate.'
  WHEN doc_id % 3 = 0 THEN '<p class="x">' || text || '</p>' ELSE text END AS description,
 CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN 'REJECTED' ELSE 'PUBLISHED' END AS state,
 CASE WHEN doc_id % 40 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN 'Withdrawn by ' || source ELSE NULL END AS rejected_reason
FROM documents""",
    "f_source_dup": """
SELECT 0 AS copy, 2 * ord AS ord, cve_id, description, state, rejected_reason FROM f_source UNION ALL
SELECT 1 AS copy, 2 * ord + 1 AS ord, cve_id, 'second copy ' || CAST(ord AS {S}) AS description, state, rejected_reason
FROM f_source WHERE ord IN (SELECT doc_id FROM documents WHERE lang IN ('de', 'es'))""",
    "f_store": "SELECT cve_id, ord FROM f_source WHERE ord IN (SELECT doc_id FROM labels)",
    "f_staged": """
SELECT d.doc_id, """ + _CVE + """ || '_keyphrases.json' AS file_name,
 CASE doc_id % 15
 WHEN 0 THEN '{"rootcause":"' || """ + _TEXT + """ || '","weakness":"' || lang || '","impact":"i","vector":"v","attacker":"a","product":"p","version":"1","component":"c"}'
 WHEN 1 THEN '{"rootcause":"","weakness":" ","impact":"","vector":"","attacker":"","product":"","version":"","component":""}'
 WHEN 2 THEN '{"rootcause":"","weakness":"' || source || '","impact":"","vector":"","attacker":"","product":"","version":"","component":""}'
 WHEN 3 THEN '{"rootcause":"r","weakness":"' || """ + _TEXT + """ || '"}'
 WHEN 4 THEN '{"rootcause":"r","weakness":"w","impact":"i","vector":"v","attacker":"a","product":"p","version":"1","component":"c","component2":"' || source || '"}'
 WHEN 5 THEN '{"rootcause":"r","weakness":"w","impact":["' || lang || '","x"],"vector":"v","attacker":"a","product":"p","version":"1","component":"c"}'
 WHEN 6 THEN '{"rootcause":"r","weakness":"w","impact":"i","vector":"","attacker":"","product":"p","version":["1","2"],"component":"' || """ + _TEXT + """ || '"}'
 WHEN 7 THEN '{"rootcause":"Unknown","weakness":"UNKNOWN","impact":"unknown","vector":"","attacker":" unknown","product":"' || source || '","version":"","component":""}'
 WHEN 8 THEN '{"rootcause":"r","weakness":"' || source
 WHEN 9 THEN '{"rootcause":"r","weakness":"w","impact":"i"} trailing ' || lang
 WHEN 10 THEN CASE WHEN doc_id % 30 = 10 THEN '["r","w"]' ELSE '{"rootcause":0,"weakness":null,"impact":false,"vector":"","attacker":true,"product":"p","version":[],"component":5}' END
 WHEN 12 THEN '{"rootcause":"' || source || '"}]'
 WHEN 13 THEN '{"rootcause":"' || lang || '"}] after'
 WHEN 14 THEN '1],[2'
 ELSE '' END AS content
FROM documents d""",
    "f_impacts": """
SELECT """ + _CVE + """ AS cve_id,
 CASE WHEN doc_id % 6 = 0 THEN {A}('i') WHEN doc_id % 6 = 1 THEN {A}('i', 'j', '') WHEN doc_id % 6 = 2 THEN {A}('') ELSE {A}('k', 'k') END AS impact_texts
FROM documents WHERE lang <> 'fr'""",
    "f_target": """
SELECT file_name, CASE WHEN doc_id % 2 = 0 THEN content ELSE content || ' ' END AS content
FROM f_staged WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "f_attempts": """
SELECT cve_id, attempt, CASE WHEN attempt = 1 THEN 'primary' ELSE 'fallback' END AS model,
 CASE WHEN (ord + attempt) % 4 = 0 THEN NULL ELSE '{"rootcause":"r","weakness":"' || CASE WHEN ord % 3 = 0 THEN '' ELSE """ + _json_text("coalesce(description, '')") + """ END || '"}' || CASE WHEN ord % 11 = 0 THEN ' done.' WHEN ord % 13 = 0 THEN ']' ELSE '' END END AS response,
 CASE WHEN (ord + attempt) % 4 <> 0 THEN NULL WHEN ord % 5 = 0 THEN '429 Resource has been exhausted' WHEN ord % 5 = 1 THEN 'Timeout after 300 s' WHEN ord % 5 = 2 THEN '503 Service Unavailable' WHEN ord % 5 = 3 THEN 'Quota exceeded' ELSE 'No answer could be read' END AS error
FROM (SELECT cve_id, ord, description, {X}({A}(1, 2, 3)) AS attempt FROM f_source WHERE cve_id IS NOT NULL) a""",
    "f_repair": """
SELECT doc_id, CASE doc_id % 9
 WHEN 0 THEN '[' || chr(39) || source || chr(39) || ', ' || chr(39) || lang || chr(39) || ']'
 WHEN 1 THEN '["' || source || chr(39) || 's", "b"]'
 WHEN 2 THEN '[ ' || chr(39) || 'a' || chr(39) || ' ]'
 WHEN 3 THEN chr(39)
 WHEN 4 THEN '  plain ' || lang || '  '
 WHEN 5 THEN '["a"]'
 WHEN 6 THEN '[]'
 WHEN 7 THEN '[' || chr(39) || 'a' || chr(39) || ', ' || chr(39) || 'b' || chr(39) || ' ]'
 ELSE '"' || source || '"' END AS value
FROM documents""",
    "f_descriptions": "SELECT " + _CVE + " AS cve_id, text AS description FROM documents WHERE lang <> 'es'",
    "f_store_docs": """
SELECT '/store/' || CASE WHEN doc_id % 13 = 0 THEN 'misc' ELSE """ + _YEAR + """ END || '/'
 || CAST(CAST(floor(""" + _NUMBER + """ / 1000) AS BIGINT) AS {S}) || 'xxx/' || """ + _CVE + """ || '.json' AS path,
 CASE doc_id % 7 WHEN 0 THEN '{"cveId":"x","keyphrases":{"impact":"' || """ + _TEXT + """ || '"}}' WHEN 1 THEN '{"cveId":"x"}'
 WHEN 2 THEN '{"cveId":"x","keyphrases":"text"}' WHEN 3 THEN '{"cveId":"x","keyphrases":null}'
 WHEN 4 THEN '{"cveId":' WHEN 5 THEN '["x"]' ELSE '{"keyphrases":{}}' END AS content
FROM documents""",
}

# fixtures each view reads, so WITH clauses can be emitted in order
_DEPS = {
    "f_source_dup": ["f_source"],
    "f_store": ["f_source"],
    "f_target": ["f_staged"],
    "f_attempts": ["f_source"],
}

_DIALECT = {
    "spark": {"S": "STRING", "A": "array", "X": "explode"},
    "duckdb": {"S": "VARCHAR", "A": "list_value", "X": "unnest"},
}


def render(name: str, dialect: str) -> str:
    d = _DIALECT[dialect]
    out = FIXTURE_SQL[name]
    for k, v in d.items():
        out = out.replace("{" + k + "}", v)
    return out.strip()


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for dep in _DEPS.get(n, []):
            visit(dep)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_clause(names, dialect: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the fixtures and their inputs."""
    parts = [f"{n} AS (\n{render(n, dialect)}\n)" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) if parts else ""


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Expose the driver tables of ``sf_dir`` as temp views."""
    for t in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a DataFrame over the tables of ``sf_dir``."""
    register_tables(spark, sf_dir, ("documents", "labels"))
    return spark.sql(f"{with_clause([name], 'spark')}\nSELECT * FROM {name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
