"""JSON strictness, typing and truthiness."""

import json

from pyspark.sql import functions as F

from conftest import one_col
from skein.functions import jsonx as J
from skein.operators import merge as M
from skein.operators import repair as R
from skein.operators import validate as V


def test_strict_ok_matches_python(spark):
    cases = ["", "{\"a\":1} junk", "{\"a\":1},{\"b\":2}", "{'a':1}", "[]", "null", "{\"a\":1,\"a\":2}",
             "5", "\"s\"", "{\"a\":1}]", "{\"a\":1}] junk", "{\"a\":1}]}", "1],[2", "[1,2]] x", "1}", "1}],[{\"v\":2", "1,\"v\":2", "[1]]", "{}}", "{\"a\":[1,{\"b\":null}]}", "  {\"a\":1}  ", "{\"a\":}", "{\"a\":\"x\ny\"}"]

    def py_ok(s):
        try:
            json.loads(s)
            return True
        except ValueError:
            return False
    got = [r[0] for r in one_col(spark, cases).select(J.strict_ok("c")).collect()]
    assert got == [py_ok(c) for c in cases]


def test_duplicate_keys_last_wins_first_position(spark):
    r = one_col(spark, ['{"a":1,"b":2,"a":3}']).select(J.parse_doc("c").alias("m")).select(
        F.map_keys("m").alias("k"), J.as_text(F.element_at("m", F.lit("a"))).alias("a")).first()
    assert r.k == ["a", "b"] and r.a == "3"


def test_truthiness(spark):
    vals = {"s": '"x"', "blank": '"  "', "zero": "0", "fzero": "0.0", "f": "false", "t": "true",
            "arr": "[]", "obj": "{}", "null": "null", "szero": '"0"', "full": "[1]", "n": "2.5"}
    doc = "{" + ",".join(f'"{k}":{v}' for k, v in vals.items()) + "}"
    m = one_col(spark, [doc]).select(J.parse_doc("c").alias("m"))
    got = m.select(*[J.truthy(F.element_at("m", F.lit(k))).alias(k) for k in vals]).first().asDict()
    assert got == {"s": True, "blank": False, "zero": False, "fzero": False, "f": False, "t": True,
                   "arr": False, "obj": False, "null": False, "szero": True, "full": True, "n": True}
    missing = m.select(J.truthy(F.element_at("m", F.lit("nope")))).first()[0]
    assert missing is False


def test_validation_issues(spark):
    docs = [
        ("a_keyphrases.json", ""),
        ("b_keyphrases.json", '{"rootcause":"r"} x'),
        ("c_keyphrases.json", '["r"]'),
        ("d_keyphrases.json", '{"rootcause":"r","weakness":["w"]}'),
        ("e_keyphrases.json", '{"rootcause":"r","weakness":"w","impact":"i","vector":"","attacker":"","product":"",'
                              '"version":["1"],"component":""}'),
        ("f_keyphrases.json", '{"rootcause":"Unknown","weakness":" unknown","impact":"","vector":"","attacker":"",'
                              '"product":"","version":"","component":""}'),
        ("g_keyphrases.json", '{"rootcause":"r","weakness":"w","impact":"","vector":"","attacker":"","product":"",'
                              '"version":"","component":"","component2":"x"}'),
    ]
    v = V.classify(spark.createDataFrame(docs, "file_name string, content string"))
    r = {x.cve_id: x for x in v.collect()}
    assert r["a"].error == "Invalid JSON" and r["a"].size == 0 and r["a"].content_hash is None
    assert r["b"].error == "Invalid JSON"
    assert r["c"].error == "JSON must be a flat object"
    assert r["d"].error == "Nested structure found in field: weakness"
    assert r["e"].json_valid and r["e"].non_empty_count == 4
    assert r["f"].single_keyphrase and not r["f"].json_valid and r["f"].content_hash is not None
    assert r["g"].extra_fields == ["component2"] and not r["g"].json_valid


def test_normalize_text_cases(spark):
    q = "'"
    cases = {f"[{q}a{q}, {q}b{q}]": "a, b", '["it\'s", "b"]': "it's, b", f"[{q}a{q}, {q}b{q} ]": f"a{q}, {q}b",
             q: "", "[]": "", '"x"': "x", "  plain  ": "plain", f"[ {q}a{q} ]": "a", '["a"]': "a"}
    got = [r[0] for r in one_col(spark, list(cases)).select(R.normalize_text("c")).collect()]
    assert got == list(cases.values())


def test_normalize_values_of_other_types(spark):
    doc = '{"n":5,"b":true,"z":null,"l":["a",1,true,null,["x",2,null]],"e":[]}'
    m = one_col(spark, [doc]).select(J.parse_doc("c").alias("m"))
    got = m.select(*[R.normalize_value(F.element_at("m", F.lit(k))).alias(k) for k in "nbzle"]).first().asDict()
    assert got == {"n": "5", "b": "True", "z": "", "l": "a, 1, True, None, x, 2", "e": ""}


def test_fold_prefixed_component(spark):
    docs = ['{"component":"c","component_a":"x","component_b":["y","z"],"impact":"i"}',
            '{"component_a":"","component_b":5}',
            '{"component_a":"only"}',
            '{"impact":"i"}']
    m = one_col(spark, docs).select(M.normalize_keyphrases(J.parse_doc("c")).alias("m"))
    out = m.select(F.map_keys("m").alias("k"), J.as_text(F.element_at("m", F.lit("component"))).alias("c")).collect()
    assert out[0].c == '["x","y","z","c"]' and out[0].k[:2] == ["component", "impact"]
    assert out[1].c == "" and "component_a" not in out[1].k
    assert out[2].c == "only"
    assert out[3].c == "" and sorted(out[3].k) == sorted(J.REQUIRED_FIELDS)


def test_repair_response(spark):
    cases = ['{"a":1}', '  {"a":1} trailing', 'prose {"a":1}', '{"a":1} x }', None, '[1,2]', '{bad']
    got = [r[0] for r in one_col(spark, cases).select(J.repair_response("c")).collect()]
    assert got == ['{"a":1}', '{"a":1}', None, None, None, '[1,2]', None]


def test_duplicate_fields_opt_in(spark):
    full = ",".join(f'"{f}":"v"' for f in J.REQUIRED_FIELDS)
    docs = [("a_keyphrases.json", "{" + full + ',"impact":"w"}'), ("b_keyphrases.json", "{" + full + "}")]
    df = spark.createDataFrame(docs, "file_name string, content string")
    off = {r.cve_id: (r.json_valid, r.duplicated_fields) for r in V.classify(df).collect()}
    on = {r.cve_id: (r.json_valid, r.duplicated_fields) for r in V.classify(df, check_duplicates=True).collect()}
    assert off == {"a": (True, None), "b": (True, None)}
    assert on == {"a": (False, ["impact"]), "b": (True, None)}
    kinds = [r.kind for r in V.issue_kinds(V.classify(df, check_duplicates=True)).collect()]
    assert kinds == ["duplicated_fields"]


def test_repair_cuts_at_the_last_brace(spark):
    cases = {'{"a":1}]': '{"a":1}', '{"a":1}] junk': '{"a":1}', '{"a":1}': '{"a":1}', "1],[2": None, ' {"a":1} x': '{"a":1}'}
    got = [r[0] for r in one_col(spark, list(cases)).select(J.repair_response("c")).collect()]
    assert got == list(cases.values())
