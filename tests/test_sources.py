"""Readers and column detection."""

import gzip
import os

import pytest

from skein.operators.validate import missing_section
from skein.sources import files as S


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)


def test_csv_multiline_na_words_and_detection(spark, tmp_dir):
    text = ('cveId,description,state,rejected_reason,extra\n'
            'CVE-2024-1,"line one\nline ""two""",PUBLISHED,,x\n'
            'CVE-2024-2,NA,REJECTED,gone,y\n'
            'null,plain,n/a,,z\n')
    _write(f"{tmp_dir}/in/a.csv", text)
    rows = S.read_csv_records(spark, f"{tmp_dir}/in").orderBy("ord").collect()
    assert [(r.cve_id, r.description, r.state, r.rejected_reason) for r in rows] == [
        ("CVE-2024-1", 'line one\nline "two"', "PUBLISHED", None),
        ("CVE-2024-2", None, "REJECTED", "gone"),
        (None, "plain", None, None)]


def test_csv_gzip(spark, tmp_dir):
    _write(f"{tmp_dir}/g/a.csv.gz", "id,summary\nCVE-2024-9,hello\n", gz=True)
    r = S.read_csv_records(spark, f"{tmp_dir}/g").collect()
    assert [(x.cve_id, x.description) for x in r] == [("CVE-2024-9", "hello")]


def test_detection_by_values(spark):
    df = spark.createDataFrame([(i, f"CVE-2024-{i}", "long text " * (i % 3 + 1), "ab", str(i)) for i in range(30)],
                               "ord long, ref string, body string, short string, num string")
    assert S.detect_columns(df) == ("ref", "body")


def test_detection_by_name_pattern_order(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "ord long, video string, cve_ref string, details string")
    assert S.detect_columns(df) == ("cve_ref", "details")


def test_detection_failure_raises(spark):
    df = spark.createDataFrame([(1, "1", "2")], "ord long, a string, b string")
    with pytest.raises(ValueError):
        S.detect_columns(df)


def test_legacy_profile_fallback(spark, tmp_dir):
    _write(f"{tmp_dir}/l/a.csv", '"CVE","Description"\n"CVE-2024-3","say \\"hi\\""\n')
    r = S.read_csv_records(spark, f"{tmp_dir}/l", profile="legacy").collect()
    assert [(x.cve_id, x.description) for x in r] == [("CVE-2024-3", 'say "hi"')]


def test_legacy_json_store_and_docs(spark, tmp_dir):
    base = f"{tmp_dir}/store"
    _write(f"{base}/2024/1xxx/CVE-2024-1234.json", '{\n  "cveId": "CVE-2024-1234",\n  "version": "1.0.0"\n}')
    _write(f"{base}/2024/1xxx/CVE-2024-1235.json", '{"cveId": ')
    _write(f"{base}/2024/1xxx/notes.json", '{"cveId": "x"}')
    df = S.read_json_store(spark, base, legacy=True)
    assert [(r.cveId, r.source_file) for r in df.collect()] == [("CVE-2024-1234", "CVE-2024-1234.json")]
    assert df.count() == 1 and not df.isEmpty()
    _write(f"{tmp_dir}/staged/CVE-2024-1_keyphrases.json", '{"rootcause":"r"}')
    _write(f"{tmp_dir}/staged/CVE-2024-2_keyphrases.json", "")
    docs = S.scan_docs(spark, f"{tmp_dir}/staged")
    assert [r.file_name for r in docs.collect()] == ["CVE-2024-1_keyphrases.json"]  # zero-byte file skipped
    man = spark.createDataFrame([("CVE-2024-1_keyphrases.json", 17), ("CVE-2024-2_keyphrases.json", 0)],
                                "file_name string, size long")
    full = S.with_manifest(docs, man)
    assert sorted((r.file_name, r.size, r.content) for r in full.collect())[1] == ("CVE-2024-2_keyphrases.json", 0, "")


def test_detection_over_the_whole_frame(spark):
    rows = [(i, None if i < 150 else f"CVE-2024-{i}", "long text " * 3) for i in range(200)]
    df = spark.createDataFrame(rows, "ord long, ref string, body string")
    assert S.detect_columns(df, sample=None) == ("ref", "body")


def test_a_schema_given_to_the_store_reader_stays_as_it_is(spark, tmp_dir):
    from pyspark.sql.types import StringType, StructField, StructType
    _write(f"{tmp_dir}/s/2024/1xxx/CVE-2024-1234.json", '{"cveId": "CVE-2024-1234"}')
    schema = StructType([StructField("cveId", StringType())])
    for _ in range(2):
        assert S.read_json_store(spark, f"{tmp_dir}/s", legacy=True, schema=schema).select("cveId").collect() == [("CVE-2024-1234",)]
    assert schema.fieldNames() == ["cveId"]


def test_single_line_csv_is_split_and_keeps_its_order(spark, tmp_dir):
    _write(f"{tmp_dir}/c/a.csv", "cveId,description\n" + "".join(f'CVE-2024-{i},"text, ""{i}"" {"x" * 50}"\n' for i in range(1000, 5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = S.read_csv_records(spark, f"{tmp_dir}/c", multiline=False)
        assert df.rdd.getNumPartitions() > 1
        assert S.read_csv_records(spark, f"{tmp_dir}/c").rdd.getNumPartitions() == 1
        rows = df.orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.cve_id, r.description) for r in rows] == [(f"CVE-2024-{i}", f'text, "{i}" {"x" * 50}') for i in range(1000, 5000)]


def test_store_paths_start_below_the_base(spark, tmp_dir):
    for at in ("2024/1xxx/CVE-2024-1234.json", "old/2024/1xxx/CVE-2024-1235.json", "misc/1xxx/CVE-2024-1236.json"):
        _write(f"{tmp_dir}/a b.c/{at}", '{"cveId":"x"}')
    docs = S.scan_store_paths(spark, f"{tmp_dir}/a b.c/")
    assert {r.path for r in docs.collect()} == {"/2024/1xxx/CVE-2024-1234.json", "/old/2024/1xxx/CVE-2024-1235.json", "/misc/1xxx/CVE-2024-1236.json"}
    assert [r.path for r in missing_section(docs).collect()] == ["/2024/1xxx/CVE-2024-1234.json"]


def test_stage_docs_of_an_absent_folder(spark, tmp_dir):
    assert S.read_stage_docs(spark, f"{tmp_dir}/none").collect() == []


# ----------------------------------------------- quoted newlines, many tasks

def _odd_text(rng, profile):
    pieces = ["a", "b c", ",", "\n", "\n\n", "x" * 30, "ü", " ", "\r\n" if profile == "standard" else ";", ',"', '",', "'"]
    t = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
    return t if profile == "standard" else t.replace("\r", "")


def _quoted(t, profile):
    return '"' + (t.replace('"', '""') if profile == "standard" else t.replace("\\", "\\\\").replace('"', '\\"')) + '"'


@pytest.mark.parametrize("profile", ["standard", "legacy"])
def test_quoted_newlines_are_read_by_many_tasks(spark, tmp_dir, profile):
    import random
    rng = random.Random(profile)
    rows = [(f"CVE-2024-{i}", _odd_text(rng, profile)) for i in range(3000)]
    rows[700] = ("CVE-2024-700", "lines\n" * 4000)  # one field over several ranges
    lines = [f"{_quoted(a, profile) if profile == 'legacy' or rng.random() < .5 else a},{_quoted(b, profile)}" for a, b in rows]
    _write(f"{tmp_dir}/q/a.csv", '"CVE","Description"\n' + "\n".join(lines) + "\n")
    _write(f"{tmp_dir}/q/b.csv", '"CVE","Description"\n"CVE-2025-1","no newline at the end"')
    _write(f"{tmp_dir}/q/c.csv", "")
    whole = S.read_csv_records(spark, f"{tmp_dir}/q", profile=profile).orderBy("ord").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = S.read_csv_records(spark, f"{tmp_dir}/q", profile=profile, multiline=S.SPLIT)
        assert df.rdd.getNumPartitions() > 10
        split = df.orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r[:2] for r in split] == [r[:2] for r in whole]
    got = [(r.cve_id, r.description) for r in split if r.cve_id != "CVE-2025-1"]
    na = lambda t: None if t in S.NA_WORDS else t
    assert got == [(a, na(b)) for a, b in rows] or profile == "standard" and [(a, (b or "").replace("\r\n", "\n")) for a, b in got] == [
        (a, (na(b.replace("\r\n", "\n")) or "")) for a, b in rows]


def test_line_states():
    from skein.sources.quoted import ends_inside as e
    assert not e("a,b", False) and e("a,b", True)
    assert e('a,"b', False) and not e('b",c', True) and e('b"",c', True) and not e('b""",c', True)
    assert not e('5" pipe,x', False) and not e('"a ""q"" b",c', False) and e('","', True)
    assert e('a","b', True) and not e('"",""', False) and e('"",""', True)
    assert e('say \\"', True, "legacy") and not e('say \\\\"', True, "legacy") and e('"a\\",b', False, "legacy")


def test_a_file_split_anew_is_not_misread(spark, tmp_dir):
    _write(f"{tmp_dir}/s/a.csv", "cveId,description\n" + "".join(f'CVE-2024-{i},"x\n{"y" * 40}"\n' for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = S.read_csv_table(spark, f"{tmp_dir}/s", multiline=S.SPLIT)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
        with pytest.raises(Exception, match="split anew"):
            df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_split_reader_on_gzip_and_header_only(spark, tmp_dir):
    _write(f"{tmp_dir}/g/a.csv.gz", 'id,summary\nCVE-2024-9,"two\nlines"\n\n', gz=True)
    assert [(r.cve_id, r.description) for r in S.read_csv_records(spark, f"{tmp_dir}/g", multiline=S.SPLIT).collect()] == [("CVE-2024-9", "two\nlines")]
    _write(f"{tmp_dir}/h/a.csv", "id,summary\n")
    assert S.read_csv_records(spark, f"{tmp_dir}/h", multiline=S.SPLIT).collect() == []


def test_large_documents_make_several_csv_files(spark, tmp_dir, monkeypatch):
    """No task writes all of them; each file is still split among tasks."""
    import glob

    from skein.plans import catalog
    rows = [(i, f'text "{i}"\nsecond, line', "en", "web") for i in range(1, 400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    paths = []
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: paths.append(f"{tmp_dir}/{name}") or paths[-1])
    want = sorted(catalog.QUERIES["read_csv_split"](spark, tmp_dir).collect(), key=str)
    assert len(glob.glob(f"{paths[-1]}/part-*")) == 1 and len(want) == 399
    monkeypatch.setattr(catalog, "CSV_FILE_BYTES", 5000)
    assert sorted(catalog.QUERIES["read_csv_split"](spark, tmp_dir).collect(), key=str) == want
    assert len(glob.glob(f"{paths[-1]}/part-*")) > 1
