"""End-to-end run modes over a CSV derived from the driver tables."""

import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from skein.fixtures import fixture
from skein.plans import pipeline as PL
from skein.plans.stub import outage_factory, stub_factory
from skein.sources import files as S


quiet = lambda seconds: None  # noqa: E731  a lambda travels to the workers by value


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/part-*", recursive=True)}


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_pipeline_runs_incrementally_and_is_idempotent(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    src = fixture(spark, SF_SMALL, "f_source").select("cve_id", "description", "state", "rejected_reason")
    S.write_csv(src, p.src())
    out = PL.run_pipeline(spark, p, stub_factory, sleep=quiet)
    st = out["extract"].first()
    assert st.successful + st.failed == st.total > 0
    summary = out["validate"]["summary"].first()
    assert summary.valid + summary.invalid == summary.total
    published = spark.read.json(p.store)
    n1 = published.count()
    assert n1 == out["merge"].first().processed > 0
    assert published.select("cveId").distinct().count() == n1
    for name in ("processing_status", "already_processed", "to_process", "processing_summary", "issue_counts", "validation"):
        assert glob.glob(f"{p.report(name)}/*.csv"), name
    # publishing the same merged records again changes no file
    before = files(p.store)
    again = PL.run_publish(spark, p).first()
    assert (again.moved, again.skipped, again.deleted) == (0, 0, n1) and files(p.store) == before
    # a second run retries only what is not published and publishes nothing twice
    second = PL.run_pipeline(spark, p, stub_factory, sleep=quiet)
    src_ids = {r.cve_id for r in S.read_csv_records(spark, p.src()).select("cve_id").collect()}
    published_ids = {r.cveId for r in published.select("cveId").collect()}
    assert second["extract"].first().total <= len(src_ids - published_ids)
    assert spark.read.json(p.store).count() == n1 and second["publish"].first().moved == 0
    years = {r.year for r in spark.read.json(p.store).select("year").distinct().collect()}
    assert years and all(1999 <= y <= 2025 for y in years)


def test_outage_is_made_good_by_the_next_run(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    S.write_csv(spark.createDataFrame([("CVE-2024-1000", "text one"), ("CVE-2024-1001", "another text")], "cve_id string, description string"), p.src())
    assert PL.run_extract(spark, p, outage_factory, sleep=quiet).first().failed == 2
    assert PL.run_extract(spark, p, stub_factory, sleep=quiet).first().successful > 0


def test_merge_mode_reads_the_stage_folders(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    for i, (kp, desc, impact) in enumerate([
            ('{"impact":"crash","component_a":"x"}', '{"description":"one"}', '{"impact_texts":["crash","leak"],"mitre_technical_impacts":["DoS"]}'),
            ('{"impact":"crash"}', "{bad", "5"),
            (None, '{"description":"no keyphrases"}', None)]):
        for kind, text in (("keyphrases", kp), ("description", desc), ("technical_impacts", impact)):
            if text is not None:
                put(f"{p.base}/{kind}/CVE-2024-100{i}_{kind}.json", text)
    st = PL.run_merge(spark, p).first()
    assert (st.processed, st.skipped_no_keyphrases, st.errors) == (2, 1, 2)
    PL.run_publish(spark, p)
    got = {r.cveId: r for r in spark.read.json(p.store).collect()}
    assert set(got) == {"CVE-2024-1000", "CVE-2024-1001"}
    assert got["CVE-2024-1000"].mitreTechnicalImpacts == ["DoS"] and got["CVE-2024-1000"].keyphrases.component == "x"
    rows = spark.read.option("header", True).csv(p.report("impact_errors")).collect()
    assert [(r.cve_id, r.direction, r["values"]) for r in rows] == [("CVE-2024-1000", "impact_texts_only", "leak")]


def test_absent_stage_folders_are_empty(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    put(f"{p.base}/keyphrases/CVE-2024-1000_keyphrases.json", '{"impact":"i"}')
    assert PL.run_merge(spark, p).first().processed == 1


def test_overwrite_touches_only_its_partitions(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    for n in (1000, 1001, 5000):
        put(f"{p.base}/keyphrases/CVE-2024-{n}_keyphrases.json", '{"impact":"i"}')
    PL.run_merge(spark, p)
    PL.run_publish(spark, p)
    before = files(f"{p.store}/year=2024/bucket=5xxx")
    put(f"{p.base}/keyphrases/CVE-2024-1000_keyphrases.json", '{"impact":"changed"}')
    PL.run_merge(spark, p)
    assert PL.run_publish(spark, p).first().skipped == 1
    st = PL.run_publish(spark, p, "overwrite").first()
    assert (st.overwritten, st.deleted) == (1, 2)
    assert {r.cveId: r.keyphrases.impact for r in spark.read.json(p.store).collect()} == {
        "CVE-2024-1000": "changed", "CVE-2024-1001": "i", "CVE-2024-5000": "i"}
    assert files(f"{p.store}/year=2024/bucket=5xxx") == before


def test_overwrite_keeps_other_buckets_of_a_shared_folder(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    for n in (1000000, 1999999, 5000):
        put(f"{p.base}/keyphrases/CVE-2024-{n}_keyphrases.json", '{"impact":"i"}')
    PL.run_merge(spark, p)
    PL.run_publish(spark, p)
    assert set(os.listdir(f"{p.store}/year=2024")) == {"bucket=1xxxxxx", "bucket=5xxx"}
    put(f"{p.base}/keyphrases/CVE-2024-1000000_keyphrases.json", '{"impact":"changed"}')
    put(f"{p.base}/keyphrases/CVE-2024-1500000_keyphrases.json", '{"impact":"new"}')
    PL.run_merge(spark, p)
    st = PL.run_publish(spark, p, "overwrite").first()
    assert (st.moved, st.overwritten, st.deleted) == (1, 1, 2)
    rows = [(r.cveId, r.keyphrases.impact) for r in spark.read.json(p.store).collect()]
    assert sorted(rows) == [("CVE-2024-1000000", "changed"), ("CVE-2024-1500000", "new"), ("CVE-2024-1999999", "i"), ("CVE-2024-5000", "i")]
    assert PL.run_publish(spark, p, "overwrite").first().deleted == 4


def test_validate_mode_lists_records_without_section(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    rows = [("CVE-2024-1000", '{"cveId":"CVE-2024-1000"}'), ("CVE-2024-1001", '{"cveId":"CVE-2024-1001","keyphrases":"text"}'),
            ("CVE-2024-1002", '{"cveId":"CVE-2024-1002","keyphrases":{}}')]
    spark.createDataFrame(rows, "id string, value string").select(F.lit(2024).alias("year"), F.lit("1xxx").alias("bucket"), "value") \
        .write.partitionBy("year", "bucket").text(p.store)
    out = PL.run_validate(spark, p)
    assert sorted(r.cveId for r in out["missing"].collect()) == ["CVE-2024-1000", "CVE-2024-1001"]


def test_repair_mode_and_copy_back(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    docs = [("CVE-2024-1000_keyphrases.json", '{"impact":["a","b"]}'), ("CVE-2024-1001_keyphrases.json", "{bad")]
    df = spark.createDataFrame(docs, "file_name string, content string")
    df.write.parquet(p.staged)
    df.write.parquet(p.invalid)
    st = PL.run_repair(spark, p, copy_back=True).first()
    assert (st.processed, st.fixed, st.failed) == (2, 1, 1)
    got = {r.file_name: r.content for r in spark.read.parquet(p.staged).collect()}
    assert '"impact":"a, b"' in got[docs[0][0]] and got[docs[1][0]] == "{bad"


def test_reprocess_mode(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    S.write_csv(spark.createDataFrame([(f"CVE-2024-{1000 + i}", "text " + "y" * i) for i in range(8)], "cve_id string, description string"), p.src())
    spark.createDataFrame([(f"CVE-2024-{1000 + i}_keyphrases.json", '{"impact":"i"}') for i in range(8)], "file_name string, content string") \
        .write.parquet(p.staged)
    spark.createDataFrame([], "cve_id string, description string").write.parquet(p.descriptions)
    st = PL.run_reprocess(spark, p, stub_factory, sleep=quiet).first()
    assert st.total == 8 and st.improved > 0 and spark.read.parquet(p.staged).count() == 8


def test_a_legacy_store_counts_as_published_and_is_scanned(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run", legacy_store=f"{tmp_dir}/legacy", csv_multiline=False)
    S.write_csv(spark.createDataFrame([(f"CVE-2024-100{i}", "some text") for i in range(3)], "cve_id string, description string"), p.src())
    put(f"{p.legacy_store}/2024/1xxx/CVE-2024-1000.json", '{\n "cveId": "CVE-2024-1000",\n "keyphrases": {}\n}')
    put(f"{p.legacy_store}/2024/1xxx/CVE-2024-1001.json", '{"cveId": "CVE-2024-1001"}')
    put(f"{p.legacy_store}/2024/1xxx/CVE-2024-1002.json", '{"cveId": ')
    assert sorted(r.cve_id for r in PL.published_ids(spark, p).collect()) == ["CVE-2024-1000", "CVE-2024-1001"]
    assert PL.run_extract(spark, p, stub_factory, sleep=quiet).first().total == 1
    assert [r.cveId for r in PL.run_validate(spark, p)["missing"].collect()] == ["CVE-2024-1001"]


def test_an_absent_legacy_store_is_empty(spark, tmp_dir):
    assert PL.published_ids(spark, PL.Paths(base=f"{tmp_dir}/run", legacy_store=f"{tmp_dir}/none")) is None


def test_a_swap_that_was_cut_short_is_finished(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")

    def version(name, text):
        spark.createDataFrame([("CVE-2024-1000_keyphrases.json", text)], "file_name string, content string").write.parquet(f"{p.staged}{name}")
    version("_previous", "old")   # set aside, and the job was lost before the second rename
    version("_next", "new")
    assert [r.content for r in PL.read_staged(spark, p).collect()] == ["new"]
    assert not os.path.exists(f"{p.staged}_previous") and not os.path.exists(f"{p.staged}_next")
    version("_next", "newer")
    PL._swap(spark, p.staged)
    assert [r.content for r in PL.read_staged(spark, p).collect()] == ["newer"]
    assert sorted(os.listdir(p.base)) == ["staged"]


# ------------------------------------------------------------ manifest

def merged_table(spark, p, docs, stamp):
    rows = [(f"CVE-2024-{n}", text) for n, text in docs.items()]
    for n, text in rows:
        put(f"{p.base}/keyphrases/{n}_keyphrases.json", text)
    PL.run_merge(spark, p, version=stamp)


def stored(spark, p):
    rows = spark.read.json(p.store).collect()
    assert len(rows) == len({r.cveId for r in rows})  # nothing twice
    return {r.cveId: r.keyphrases.impact for r in rows}


def test_a_second_publish_reads_no_document(spark, tmp_dir, monkeypatch):
    p = PL.Paths(base=f"{tmp_dir}/run")
    merged_table(spark, p, {n: '{"impact":"i"}' for n in (1000, 1001, 5000)}, "1")
    assert PL.run_publish(spark, p).first().moved == 3

    def never(*_):
        raise AssertionError("the store was read")
    reader = PL.read_store
    monkeypatch.setattr(PL, "settle_publish", lambda *_: None)
    monkeypatch.setattr(PL, "read_store", never)
    st = PL.run_publish(spark, p).first()
    assert (st.moved, st.deleted) == (0, 3)
    put(f"{p.base}/keyphrases/CVE-2024-7000_keyphrases.json", '{"impact":"new"}')
    PL.run_merge(spark, p)
    assert PL.run_publish(spark, p).first().moved == 1
    monkeypatch.setattr(PL, "read_store", reader)
    assert set(stored(spark, p)) == {f"CVE-2024-{n}" for n in (1000, 1001, 5000, 7000)}
    assert sorted(r.cve_id for r in PL.published_ids(spark, p).collect()) == sorted(stored(spark, p))


def test_a_publish_cut_off_before_the_manifest_is_made_good(spark, tmp_dir, monkeypatch):
    p = PL.Paths(base=f"{tmp_dir}/run")
    merged_table(spark, p, {n: '{"impact":"i"}' for n in (1000, 5000)}, "1")
    append = PL.manifest.append
    for docs, conflict in (({}, "skip"), ({1000: '{"impact":"changed"}', 1002: '{"impact":"n"}', 9000: '{"impact":"o"}'}, "overwrite")):
        merged_table(spark, p, docs, "1")

        def cut(*_):
            raise RuntimeError("cut off")
        monkeypatch.setattr(PL.manifest, "append", cut)
        try:
            PL.run_publish(spark, p, conflict)
            raise AssertionError("not cut off")
        except RuntimeError as e:
            assert str(e) == "cut off"
        monkeypatch.setattr(PL.manifest, "append", append)
        st = PL.run_publish(spark, p, conflict).first()
        assert (st.moved, st.overwritten, st.skipped) == (0, 0, 0)  # the store held it all
    assert stored(spark, p) == {"CVE-2024-1000": "changed", "CVE-2024-1002": "n", "CVE-2024-5000": "i", "CVE-2024-9000": "o"}
    assert not os.path.exists(p.publish_note)


def test_a_replacement_cut_off_half_way_is_finished(spark, tmp_dir, monkeypatch):
    p = PL.Paths(base=f"{tmp_dir}/run")
    merged_table(spark, p, {n: '{"impact":"i"}' for n in (1000, 1001, 5000)}, "1")
    PL.run_publish(spark, p)
    merged_table(spark, p, {1000: '{"impact":"changed"}'}, "1")
    write, calls = PL.publish.write_store, []

    def cut(*args, **kw):
        calls.append(args)
        if len(calls) == 2:  # the new partitions are built, none is in place
            raise RuntimeError("cut off")
        write(*args, **kw)
    monkeypatch.setattr(PL.publish, "write_store", cut)
    try:
        PL.run_publish(spark, p, "overwrite")
    except RuntimeError:
        pass
    monkeypatch.setattr(PL.publish, "write_store", write)
    assert stored(spark, p)["CVE-2024-1000"] == "i"
    assert PL.run_publish(spark, p, "overwrite").first().deleted == 3
    assert stored(spark, p) == {"CVE-2024-1000": "changed", "CVE-2024-1001": "i", "CVE-2024-5000": "i"}


def test_a_store_without_a_manifest_gets_one(spark, tmp_dir):
    p = PL.Paths(base=f"{tmp_dir}/run")
    merged_table(spark, p, {n: '{"impact":"i"}' for n in (1000, 5000)}, "1")
    PL.run_publish(spark, p)
    import shutil
    shutil.move(p.store_manifest, f"{tmp_dir}/away")
    st = PL.run_publish(spark, p).first()
    assert (st.moved, st.deleted) == (0, 2) and len(stored(spark, p)) == 2


# ------------------------------------------------------------- journal

class Stopped(Exception):
    pass


def stop_after_every_step(spark, p, monkeypatch, mode, **kw):
    """Runs a mode, cutting it off after each step and starting it again."""
    enter, steps = PL.Journal.enter, []

    def cut(self, step):
        enter(self, step)
        steps.append(step)
        raise Stopped
    monkeypatch.setattr(PL.Journal, "enter", cut)
    for _ in range(20):
        try:
            out = PL.run_pipeline(spark, p, mode=mode, sleep=quiet, run_id="r1", **kw)
            break
        except Stopped:
            pass
    monkeypatch.setattr(PL.Journal, "enter", enter)
    return out, steps


def test_a_run_cut_off_after_every_step_goes_on(spark, tmp_dir, monkeypatch):
    texts = [(f"CVE-2024-{1000 + i}", "some text " + "y" * i) for i in range(24)]
    whole, cut = PL.Paths(base=f"{tmp_dir}/whole"), PL.Paths(base=f"{tmp_dir}/cut")
    for p in (whole, cut):
        S.write_csv(spark.createDataFrame(texts, "cve_id string, description string"), p.src())
    want = PL.run_pipeline(spark, whole, stub_factory, sleep=quiet)
    got, steps = stop_after_every_step(spark, cut, monkeypatch, "incremental", client_factory=stub_factory)
    assert steps == ["extract.prepare", "extract.descriptions", "extract.calls", "extract.stage", "extract.reports",
                     "validate.classify", "validate.split", "validate.swap", "validate.reports", "validate.missing", "merge", "publish"]
    for k in ("extract", "merge", "publish"):
        assert got[k].collect() == want[k].collect()
    assert got["validate"]["summary"].collect() == want["validate"]["summary"].collect()
    for name in ("invalid", "staged", "descriptions"):
        a, b = (sorted(map(str, spark.read.parquet(getattr(p, name)).collect())) for p in (whole, cut))
        assert a == b and (a or name == "invalid")
    docs = [sorted((r.cveId, str(r.keyphrases)) for r in spark.read.json(p.store).collect()) for p in (whole, cut)]
    assert docs[0] == docs[1] and docs[0]
    # the finished run, started again, does nothing; another run finds all done
    before = files(cut.base)
    PL.run_pipeline(spark, cut, stub_factory, sleep=quiet, run_id="r1")
    assert files(cut.base) == before


def test_validate_and_merge_modes_alone_go_on_too(spark, tmp_dir, monkeypatch):
    p = PL.Paths(base=f"{tmp_dir}/run")
    docs = [("CVE-2024-1000_keyphrases.json", '{"rootcause":"r","weakness":"w","impact":"i","vector":"","attacker":"","product":"","version":"","component":""}'),
            ("CVE-2024-1001_keyphrases.json", "{bad")]
    spark.createDataFrame(docs, "file_name string, content string").write.parquet(p.staged)
    out, steps = stop_after_every_step(spark, p, monkeypatch, "validate")
    assert steps == ["validate.classify", "validate.split", "validate.swap", "validate.reports", "validate.missing"]
    assert [r.file_name for r in spark.read.parquet(p.staged).collect()] == [docs[0][0]]
    assert [r.file_name for r in spark.read.parquet(p.invalid).collect()] == [docs[1][0]]
    assert (out["validate"]["summary"].first().valid, out["validate"]["summary"].first().invalid) == (1, 1) and set(out) == {"validate"}
    out, steps = stop_after_every_step(spark, p, monkeypatch, "merge")
    assert steps == ["merge", "publish"] and set(out) == {"merge", "publish"}
    assert (out["merge"].first().processed, out["publish"].first().moved) == (1, 1)
    assert [r.cveId for r in spark.read.json(p.store).collect()] == ["CVE-2024-1000"]


def test_a_mode_or_run_id_that_is_none(spark, tmp_dir):
    import pytest
    p = PL.Paths(base=f"{tmp_dir}/run")
    with pytest.raises(ValueError):
        PL.run_pipeline(spark, p, mode="everything")
    with pytest.raises(ValueError):
        PL.run_pipeline(spark, p, mode="merge", run_id="../x")


def test_repair_mode_signals_failed_documents(spark, tmp_dir):
    import pytest
    p = PL.Paths(base=f"{tmp_dir}/run")
    docs = [("CVE-2024-1000_keyphrases.json", '{"impact":["a","b"]}'), ("CVE-2024-1001_keyphrases.json", "{bad")]
    df = spark.createDataFrame(docs, "file_name string, content string")
    df.write.parquet(p.invalid)
    assert PL.run_repair(spark, p).first().exit_code == 1
    with pytest.raises(PL.DocsFailed) as e:
        PL.run_repair(spark, p, fail_on_error=True)
    assert (e.value.stats.failed, e.value.stats.processed) == (1, 2)
    assert [r.cve_id for r in spark.read.option("header", True).csv(p.report("repair_failed")).collect()] == ["CVE-2024-1001"]
    df.limit(1).write.mode("overwrite").parquet(p.invalid)
    assert PL.run_repair(spark, p, fail_on_error=True).first().exit_code == 0
