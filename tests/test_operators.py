"""Joins, grouping and publishing semantics."""

from pyspark.sql import functions as F

from skein.operators import ingest, merge, publish


def test_anti_join_null_keys_match_each_other(spark):
    src = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "ord long, cve_id string")
    done = spark.createDataFrame([("a",), (None,)], "cve_id string")
    assert sorted(r.ord for r in ingest.incremental_anti(src, done).collect()) == [3]
    done2 = spark.createDataFrame([("a",)], "cve_id string")
    assert sorted(r.ord for r in ingest.incremental_anti(src, done2).collect()) == [2, 3]
    assert ingest.incremental_anti(src, None).count() == 3


def test_anti_join_plan_is_equi_join(spark):
    src = spark.createDataFrame([(1, "a")], "ord long, cve_id string")
    done = spark.createDataFrame([("a",)], "cve_id string")
    plan = ingest.incremental_anti(src, done)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "NestedLoop" not in plan


def test_first_wins_by_order_and_skewed_key(spark):
    rows = [(i, "hot", f"d{i}") for i in range(300, 0, -1)] + [(5, "cold", "c5"), (2, "cold", "c2")]
    df = spark.createDataFrame(rows, "ord long, cve_id string, description string").repartition(7)
    out = {r.cve_id: (r.ord, r.description) for r in ingest.first_wins(df).collect()}
    assert out == {"hot": (1, "d1"), "cold": (2, "c2")}
    plan = ingest.first_wins(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side pre-aggregation before the shuffle


def test_records_to_process_cleans_only_new_rows(spark):
    src = spark.createDataFrame([(1, "CVE-1", "<b>x</b>", "PUBLISHED", None), (2, "CVE-2", "y", None, None),
                                 (3, "CVE-3", " ", "REJECTED", "gone"), (4, "CVE-4", "ConsultIDs: none", None, None)],
                                "ord long, cve_id string, description string, state string, rejected_reason string")
    done = spark.createDataFrame([("CVE-2",)], "cve_id string")
    out = ingest.records_to_process(src, done)
    assert sorted((r.cve_id, r.description) for r in out.collect()) == [("CVE-1", "x"), ("CVE-3", "gone")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the cleaning (Generate over the cleaned text) sits above the anti-join
    assert plan.index("Generate") < plan.index("LeftAnti")


def test_merge_envelopes_and_semantics(spark):
    kp = spark.createDataFrame([("CVE-1", '{"impact":"i","component":"c","component_x":"d"}'),
                                ("CVE-2", '["not","object"]'),
                                ("CVE-3", "{bad"),
                                ("CVE-5", "{bad")], "cve_id string, content string")
    desc = spark.createDataFrame([("CVE-1", "one"), ("CVE-3", "three"), ("CVE-4", "four")],
                                 "cve_id string, description string")
    imp = spark.createDataFrame([("CVE-1", ["i", "j", ""]), ("CVE-4", ["k"])], "cve_id string, impact_texts array<string>")
    g = merge.merge_records(kp, desc, imp)
    m = {r.cve_id: r for r in merge.merged(g).collect()}
    assert set(m) == {"CVE-1", "CVE-2", "CVE-3"}  # CVE-5: invalid and nothing else; CVE-4: no keyphrase file
    assert m["CVE-2"].keyphrases is None and m["CVE-3"].description == "three"
    st = merge.merge_stats(g).first()
    assert (st.processed, st.skipped_no_keyphrases, st.errors) == (3, 2, 3)
    mm = merge.impact_mismatch(merge.merged(g)).collect()
    assert [(r.cve_id, r.direction, r["values"]) for r in mm] == [("CVE-1", "impact_texts_only", ["j"])]


def test_publish_actions_and_idempotence(spark):
    src = spark.createDataFrame([("CVE-2024-0042.json", "a"), ("CVE-2024-1500.json", "b"), ("CVE-2024-1501.json", "c"),
                                 ("notes.txt", "z")], "file_name string, content string")
    tgt = spark.createDataFrame([("CVE-2024-1500.json", "b"), ("CVE-2024-1501.json", "old")],
                                "file_name string, content string")
    acts = {r.file_name: (r.year, r.bucket, r.action) for r in publish.publish_actions(src, tgt).collect()}
    assert acts == {"CVE-2024-0042.json": (2024, "0xxx", "moved"), "CVE-2024-1500.json": (2024, "1xxx", "deleted"),
                    "CVE-2024-1501.json": (2024, "1xxx", "skipped")}
    store = publish.next_store(src, tgt.withColumn("year", F.lit(2024)).withColumn("bucket", F.lit("1xxx")))
    again = publish.next_store(src, store)
    assert sorted(map(tuple, store.collect())) == sorted(map(tuple, again.collect()))
    over = {r.file_name: r.content for r in publish.next_store(
        src, tgt.withColumn("year", F.lit(2024)).withColumn("bucket", F.lit("1xxx")), "overwrite").collect()}
    assert over["CVE-2024-1501.json"] == "c"


def test_write_and_read_store(spark, tmp_dir):
    df = spark.createDataFrame([("CVE-2024-0042.json", '{"cveId":"CVE-2024-0042"}')], "file_name string, content string")
    publish.write_store(publish.next_store(df, None).select("year", "bucket", F.col("content").alias("value")),
                        tmp_dir, fmt="text")
    back = spark.read.text(tmp_dir).collect()
    assert [(r.year, r.bucket) for r in back] == [(2024, "0xxx")]


def test_write_store_splits_hot_bucket(spark, tmp_dir):
    """A bucket with a third of all records is written by several tasks
    (rebalance + AQE), and a dynamic overwrite replaces only the touched
    partitions."""
    import glob
    import hashlib

    def body(i):  # incompressible, so shuffle sizes reflect the row count
        return "".join(hashlib.sha256(f"{i}-{k}".encode()).hexdigest() for k in range(4))
    hot = [(f"CVE-2024-{1000 + i % 999}.json", body(i)) for i in range(3000)]
    cold = [(f"CVE-{2000 + i % 20}-{5000 + i}.json", body(-i - 1)) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "file_name string, content string").repartition(8)
    out = publish.next_store(df, None).select("year", "bucket", F.col("content").alias("value"))
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        publish.write_store(out, tmp_dir, fmt="text")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)
    hot_files = glob.glob(f"{tmp_dir}/year=2024/bucket=1xxx/part-*")
    assert len(hot_files) > 1
    assert spark.read.text(tmp_dir).count() == 9000
    one = spark.createDataFrame([("CVE-2024-1234.json", "z")], "file_name string, content string")
    publish.write_store(publish.next_store(one, None).select("year", "bucket", F.col("content").alias("value")),
                        tmp_dir, fmt="text")
    back = spark.read.text(tmp_dir)
    assert back.filter((F.col("year") == 2024) & (F.col("bucket") == "1xxx")).count() == 1
    assert back.count() == 6001


def test_outcome_routing_reads_its_input_once(spark, tmp_dir):
    from skein.operators import infer
    rows = [("a", 1, "primary", None, "503"), ("a", 2, "fallback", '{"impact":"i"}', None), ("a", 3, "fallback", '{"impact":"j"}', None),
            ("b", 1, "primary", None, "503"), ("c", 1, "primary", '{"impact":"i"}]', None)]
    spark.createDataFrame(rows, "cve_id string, attempt int, model string, response string, error string").write.parquet(f"{tmp_dir}/a")
    out = infer.route_outcomes(spark.read.parquet(f"{tmp_dir}/a"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # counts by call, counts by id, and the rebuilt rows are dealt out; the first sends counts, not calls
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 3
    assert "partial_count" in plan[plan.rindex("Exchange"):]
    assert sorted((r.cve_id, r.attempt or 0, r.route) for r in out.collect()) == [
        ("a", 1, "error"), ("a", 2, "success"), ("b", 0, "failed"), ("b", 1, "error"), ("c", 1, "success")]


def test_outcome_routing_of_repeated_calls(spark, monkeypatch):
    from skein.operators import infer
    monkeypatch.setattr(infer, "ROWS_AT_ONCE", 7, raising=False)
    rows = 50 * [("a", 1, "primary", None, "503")] + 20 * [("a", 2, "fallback", '{"impact":"i"}', None)] + 3 * [("a", 2, "fallback", None, "503")]
    rows += 9 * [("a", 3, "fallback", None, "503")] + 15 * [(None, 1, "primary", None, "503")] + 2 * [("b", None, "primary", None, "503")]
    out = infer.route_outcomes(spark.createDataFrame(rows, "cve_id string, attempt int, model string, response string, error string"))
    got = {(r.cve_id, r.attempt, r.route): r["count"] for r in out.groupBy("cve_id", "attempt", "route").count().collect()}
    assert got == {("a", 1, "error"): 50, ("a", 2, "success"): 20, ("a", 2, "error"): 3, (None, 1, "error"): 15, (None, None, "failed"): 1,
                   ("b", None, "error"): 2, ("b", None, "failed"): 1}
    # the array is made of counts
    aggregates = [n for n in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in n]
    assert len(aggregates) == 2 and "collect_list" in aggregates[0] and "count(1)" in aggregates[1]


def test_balance_keeps_the_scan_unless_told(spark, tmp_dir):
    from skein.operators.layout import SCAN_PARTITIONS, balance
    spark.range(10).write.parquet(f"{tmp_dir}/r")
    df = spark.read.parquet(f"{tmp_dir}/r")
    assert "Exchange" not in balance(df)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(SCAN_PARTITIONS, "3")
    try:
        assert "Exchange" in balance(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(SCAN_PARTITIONS)


def test_large_store_anti_join_equals_the_plain_one(spark):
    from skein.operators import ingest
    src = spark.createDataFrame([(i, f"CVE-{i}" if i % 10 else None) for i in range(400)] + [(1000, "CVE-1")], "ord long, cve_id string").repartition(3)
    done = spark.createDataFrame([(f"CVE-{i}",) for i in range(0, 3000, 3)], "k string").repartition(4)
    with_null = done.unionByName(spark.createDataFrame([(None,)], "k string"))
    for store in (done, with_null, done.limit(0)):
        want = sorted(r.ord for r in ingest.incremental_anti(src, store, done_key="k").collect())
        for bits in (1 << 27, 1 << 16, 1 << 15):  # the smaller ones let many keys through
            got = ingest.incremental_anti_large(src, store, done_key="k", bits=bits)
            assert got.columns == src.columns and sorted(r.ord for r in got.collect()) == want
    assert ingest.incremental_anti_large(src, None) is src


def test_large_store_anti_join_shuffles_only_matching_keys(spark):
    from skein.operators import ingest
    src = spark.createDataFrame([(i, f"CVE-{i}") for i in range(100)], "ord long, cve_id string")
    done = spark.range(50, 50_000).selectExpr("concat('CVE-', id) AS k")
    words = ingest.key_filter(src, "cve_id", 1 << 20)
    assert words.count() <= 32
    let_through = ingest.with_maybe(done, "k", words, 1 << 20).filter("__maybe")
    assert 50 <= let_through.count() < 70
    plan = let_through._jdf.queryExecution().executedPlan().toString()
    store_side = plan[plan.index("Range"):] if "Range" in plan else ""
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(k" not in plan and store_side
    assert sorted(r.ord for r in ingest.incremental_anti_large(src, done, done_key="k").collect()) == list(range(50))


def test_status_and_lookup_move_no_long_text(spark):
    from skein.operators import ingest
    rows = spark.createDataFrame([(i, f"CVE-{i}", "long " * 100, None, None) for i in range(5)], "ord long, cve_id string, description string, state string, rejected_reason string")
    ids = spark.createDataFrame([("CVE-1",)], "cve_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ingest.processing_status(rows, ids, ids)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index("substring(description") if "substring(description" in plan else plan.index("Join") < plan.rindex("Generate")
        look = ingest.description_lookup(ids, spark.createDataFrame([], "cve_id string, description string"), rows)
        assert [(r.cve_id, r.found_in) for r in look.collect()] == [("CVE-1", "source")]
        plan = look._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" in plan and plan.index("Aggregate") < plan.index("LeftSemi")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicate_groups_scan_texts_once_and_rule_out_singles(spark, tmp_dir):
    from skein.operators import validate as V
    rows = [(i, f"text {i}") for i in range(300)] + [(1000 + i, "hot text") for i in range(150)] + [(2000, "text 7"), (2001, None), (2002, None), (2003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = V.duplicate_groups(docs, "doc_id", "text")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan.replace("content_hash", "")  # only the landed hashes are read
    out = {(r.doc_id, r.n_copies) for r in got.collect()}
    assert out == {(1000 + i, 150) for i in range(150)} | {(7, 2), (2000, 2)}
    assert V.duplicate_groups(docs.limit(0), "doc_id", "text").collect() == []


def test_high_numbers_share_folders(spark, tmp_dir):
    """The number of folders doesn't grow with the records; buckets up to
    99xxx keep their own."""
    import glob

    from skein.functions import ids
    from skein.operators import manifest
    rows = [(f"CVE-{y}-{n}.json", f'{{"cveId":"CVE-{y}-{n}"}}') for y in (2023, 2024) for n in (1000, 99999, *range(100000, 10000000, 33333))]
    docs = publish.next_store(spark.createDataFrame(rows, "file_name string, content string"), None)
    publish.write_store(docs.select("year", "bucket", F.col("content").alias("value")), tmp_dir, fmt="text")
    assert len(glob.glob(f"{tmp_dir}/year=*/bucket=*")) == 2 * 20
    back = spark.read.text(tmp_dir)
    assert back.count() == len(rows)
    one = spark.createDataFrame([(2024, "1000xxx"), (2023, "99xxx")], "year int, bucket string")
    got = manifest.read_partitions(back, one)
    assert {(r.year, r.bucket) for r in got.select("year", "bucket").distinct().collect()} == {(2024, "1xxxxxx"), (2023, "99xxx")}
    names = spark.createDataFrame([(b,) for b in ("0xxx", "99xxx", "100xxx", "1000xxx", "9999xxx", "9xxxxx", None)], "b string")
    assert [r[0] for r in names.select(ids.folder("b")).collect()] == ["0xxx", "99xxx", "1xxxxx", "1xxxxxx", "9xxxxxx", "9xxxxx", None]
