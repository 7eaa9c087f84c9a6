"""Incremental stream: one id in several micro-batches and runs."""

import pytest

from skein.session import path_exists
from skein.streaming import incremental as ST


def drop(spark, folder, n, rows):
    spark.createDataFrame(rows, ST.SOURCE_SCHEMA).coalesce(1).write.parquet(f"{folder}/drop={n}")


def test_an_id_in_several_batches_is_emitted_once(spark, tmp_dir):
    source, sink, ckpt = (f"{tmp_dir}/{x}" for x in ("source", "sink", "ckpt"))
    for n in range(4):  # one file a drop, one file a micro-batch
        drop(spark, source, n, [(10 * n, "CVE-2024-1000", f"text {n}", None, None), (10 * n + 1, f"CVE-2024-{2000 + n}", "own", None, None),
                                (10 * n + 2, None, f"no id {n}", None, None)])
    store = spark.createDataFrame([("CVE-2024-2003",)], "cve_id string")
    got = ST.run_incremental(spark, source, sink, ckpt, store, files_per_batch=1).collect()
    ids = [r.cve_id for r in got]
    assert sorted(ids, key=str) == ["CVE-2024-1000", "CVE-2024-2000", "CVE-2024-2001", "CVE-2024-2002", None]
    # the next run sees only the new drop, and its known ids add nothing
    drop(spark, source, 4, [(50, "CVE-2024-1000", "late", None, None), (51, "CVE-2024-2009", "new", None, None)])
    again = ST.run_incremental(spark, source, sink, ckpt, store, files_per_batch=1).collect()
    assert len(again) == len(got) + 1 and {r.cve_id for r in again} - set(ids) == {"CVE-2024-2009"}


def test_errors_other_than_an_absent_sink_are_raised(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    batch = spark.createDataFrame([(1, "CVE-2024-1000", "text", None, None)], ST.SOURCE_SCHEMA)
    assert not path_exists(spark, sink)
    ST.process_batch(batch, None, sink)
    with open(f"{sink}/year=2024/bucket=1xxx/part-bad.parquet", "w") as f:  # a file that the batch has to open
        f.write("not parquet")
    with pytest.raises(Exception):
        ST.process_batch(batch, None, sink)


def test_a_batch_opens_only_files_that_may_hold_its_ids(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    for year in (2019, 2020, 2021):
        rows = [(n, f"CVE-{year}-{n}", "text", None, None) for n in range(1000, 5000, 500)] + [(9, None, f"none {year}", None, None), (8, f"X-{year}", "other form", None, None)]
        ST.process_batch(spark.createDataFrame(rows, ST.SOURCE_SCHEMA), None, sink)
    def files_opened(df):
        qe = df._jdf.queryExecution()
        qe.toRdd().count()
        return qe.executedPlan().collectLeaves().apply(0).metrics().get("numFiles").get().value()

    assert files_opened(ST.read_sink(spark, sink)) >= 15
    batch = ST.by_id(spark.createDataFrame([("CVE-2020-1400",), ("CVE-2020-1500",), ("CVE-2021-4999",), ("CVE-2030-1000",)], "cve_id string"))
    opened = ST.manifest.read_partitions(ST.read_sink(spark, sink), batch)
    assert files_opened(opened) == 2 and {(r.year, r.bucket) for r in opened.collect()} == {(2020, "1xxx"), (2021, "4xxx")}
    plan = ST.seen_ids(spark, sink, batch)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert [r.cve_id for r in ST.seen_ids(spark, sink, batch).collect()] == ["CVE-2020-1500"]
    # ids of another form and null ids have a partition of their own
    odd = ST.by_id(spark.createDataFrame([(None,), ("X-2019",)], "cve_id string"))
    assert sorted({r.cve_id for r in ST.seen_ids(spark, sink, odd).collect()}, key=str) == sorted([None, "X-2019"], key=str)
    assert files_opened(ST.manifest.read_partitions(ST.read_sink(spark, sink), odd)) <= 3


def test_high_numbers_share_sink_folders(spark, tmp_dir):
    import glob
    source, sink, ckpt = (f"{tmp_dir}/{x}" for x in ("source", "sink", "ckpt"))
    for n in range(2):
        drop(spark, source, n, [(i, f"CVE-2024-{i}", f"text {n}", None, None) for i in range(100000 + n * 50000, 9000000, 100000)])
    got = ST.run_incremental(spark, source, sink, ckpt, None, files_per_batch=1).collect()
    assert len(got) == len({r.cve_id for r in got}) == len(range(100000, 9000000, 100000)) + len(range(150000, 9000000, 100000))
    assert len(glob.glob(f"{sink}/year=2024/bucket=*")) <= 17
