"""Edge cases of the text expressions."""

from pyspark.sql import functions as F

from conftest import one_col
from skein.functions import ids as I
from skein.functions import text as T


def col(spark, values, expr):
    return [r[0] for r in one_col(spark, values).select(expr(F.col("c"))).collect()]


def test_strip_and_blank_python_whitespace(spark):
    vals = [" a ", " x ", "\x1c\x1fy\x85", "　", None, "\t\n"]
    assert col(spark, vals, T.strip) == ["a", "x", "y", "", None, ""]
    assert col(spark, vals, T.blank) == [False, False, False, True, True, True]


def test_clean_glues_lines_and_keeps_tabs_as_space(spark):
    assert col(spark, ["a.\nB", "a\tb", "x: y; 'z' \"w\""], T.clean_description) == ["a.B", "a b", "x y z w"]


def test_clean_order_and_null(spark):
    vals = ["<b>Héllo</b>  wörld\r\n", None, "<p class=\"x\">t</p>", "😀smile"]
    assert col(spark, vals, T.clean_description) == ["Hllo wrld", "", "t", "smile"]


def test_kernel_trace_needs_digit_after_bracket(spark):
    p = T.KERNEL_PREFIX
    vals = [f"{p} x [12.34] tail", f"{p} x [ 12.34] tail BUG kernel y", f"{p} a [#1] b", "other [1.2] t"]
    out = col(spark, vals, T.trim_kernel_trace)
    assert out == [f"{p} x", f"{p} x [ 12.34] tail", f"{p} a", "other [1.2] t"]


def test_rejected_fill_and_null_state_kept(spark):
    df = spark.createDataFrame([("", "REJECTED", "why"), (" ", None, "r"), ("", "REJECTED", None), ("d", "PUBLISHED", None)],
                               "d string, s string, r string")
    out = df.select(T.rejected_fill("d", "s", "r").alias("d"), "s").select(
        "d", T.keep_not_rejected_blank("d", "s").alias("keep")).collect()
    assert [(r.d, r.keep) for r in out] == [("why", True), (" ", True), (None, False), ("d", True)]


def test_placeholders_case_insensitive(spark):
    vals = ["do not use this candidate number", "x consultids y", "Reason This candidate is a duplicate.", "fine", "  "]
    assert col(spark, vals, T.keep_valid_text) == [False, False, False, True, False]


def test_truncate_200_code_points(spark):
    s = "é" * 201
    assert col(spark, [s, "ab", None], T.truncate_200) == ["é" * 200 + "...", "ab", None]
    assert col(spark, [s, None], T.text_length) == [201, 0]


def test_id_layout(spark):
    names = ["CVE-2024-0042.json", "CVE-2024-1234567.json", "CVE-2024-1234.json.bak", "CVE-24-1.json", "x.json"]
    df = one_col(spark, names).filter(I.publish_name_ok("c"))
    out = df.select("c", I.id_year("c").alias("y"), I.bucket(I.id_number("c")).alias("b")).collect()
    assert [(r.c, r.y, r.b) for r in out] == [("CVE-2024-0042.json", 2024, "0xxx"),
                                            ("CVE-2024-1234567.json", 2024, "1234xxx"),
                                            ("CVE-2024-1234.json.bak", 2024, "1xxx")]


def test_keys_from_names(spark):
    out = one_col(spark, ["CVE-2024-1_keyphrases.json", "CVE-2024-2_description.json"]).select(
        I.key_from_suffix("c"), I.key_from_split("c")).collect()
    assert [tuple(r) for r in out] == [("CVE-2024-1", "CVE-2024-1"), ("CVE-2024-2_description.json", "CVE-2024-2")]
    out = col(spark, ["CVEs/keyphrases/CVE-2021-44228_keyphrases.json", "CVE-2020-1234", "none"], I.id_in_text)
    assert out == ["CVE-2021-44228", "CVE-2020-1234", ""]
