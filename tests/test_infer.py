"""Inference job: stub ladder against a plain-Python model of the rules."""

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from skein.functions.jsonx import REQUIRED_FIELDS
from skein.operators import infer as N
from skein.operators import ladder as L
from skein.plans.stub import StepClock, StubClient, outage_factory, stub_factory
from skein.session import scratch_path


def _py_ladder(desc):
    """Plain-Python model of attempt 1 (+ gate), 2 and 3 with the stub."""
    c = StubClient()

    def call(prompt, model):
        try:
            text = c.generate(prompt, model)
        except Exception:
            return None
        body = text.strip()
        if not body.startswith("{"):
            return None
        return body[: body.rindex("}") + 1]

    def count(js):
        import json
        d = json.loads(js)
        return sum(1 for f in REQUIRED_FIELDS if isinstance(d.get(f), str) and d[f].strip())
    js = call(N.EXTRACT_INSTRUCTION + desc, N.PRIMARY)
    if js is not None:
        n = count(js)
        if n <= 1:
            e = call(N.ENHANCE_HEAD + js + N.ENHANCE_MID + desc + N.ENHANCE_TAIL, N.FALLBACK)
            if e is not None and count(e) > n:
                return ("success", 1, count(e), True)
        return ("success", 1, n, False)
    for a in (2, 3):
        js = call(N.EXTRACT_INSTRUCTION + desc, N.FALLBACK)
        if js is not None:
            return ("success", a, count(js), False)
    return ("failed", None, None, False)


def test_ladder_matches_python_model(spark):
    descs = [f"description {'x' * i}" for i in range(120)]
    recs = spark.createDataFrame([(f"CVE-2024-{i}", d) for i, d in enumerate(descs)], "cve_id string, description string")
    out = L.run_ladder(recs, scratch_path(spark, "t-att"), stub_factory, sleep=lambda s: None)
    got = {r.cve_id: (r.status, r.attempt, r.n, r.enhanced) for r in out.collect()}
    want = {f"CVE-2024-{i}": _py_ladder(d) for i, d in enumerate(descs)}
    assert got == want


def test_resume_skips_recorded_calls(spark):
    recs = spark.createDataFrame([("CVE-1", "abc"), ("CVE-2", "abcd")], "cve_id string, description string")
    path = scratch_path(spark, "t-resume")
    L.run_ladder(recs, path, stub_factory, run_id="a", sleep=lambda s: None)
    n1 = spark.read.parquet(path).count()
    L.run_ladder(recs, path, stub_factory, run_id="a", sleep=lambda s: None)
    assert spark.read.parquet(path).count() == n1  # nothing called twice
    L.run_ladder(recs, path, stub_factory, run_id="b", sleep=lambda s: None)
    assert spark.read.parquet(path).count() > n1  # another run calls anew


def test_outage_then_recovery(spark):
    recs = spark.createDataFrame([(f"CVE-{i}", "abc" * i) for i in range(1, 12)], "cve_id string, description string")
    path = scratch_path(spark, "t-outage")
    down = L.run_ladder(recs, path, outage_factory, run_id="down", sleep=lambda s: None).collect()
    assert {r.status for r in down} == {"failed"} and len(down) == 11
    up = L.run_ladder(recs, path, stub_factory, run_id="up", sleep=lambda s: None).collect()
    alone = L.run_ladder(recs, scratch_path(spark, "t-alone"), stub_factory, sleep=lambda s: None).collect()
    assert sorted(up) == sorted(alone) and {"success"} <= {r.status for r in up}


def test_array_answers_are_enhanced(spark):
    class ArrayClient:
        """Valid JSON that isn't an object, then an object when asked to enhance."""

        def generate(self, prompt, model, timeout=None):
            return '{"rootcause":"r","weakness":"w"}' if "CURRENT KEYPHRASES" in prompt and "[1,2]" in prompt else "[1,2]"
    recs = spark.createDataFrame([("CVE-1", "abc")], "cve_id string, description string")
    r = L.run_ladder(recs, scratch_path(spark, "t-array"), ArrayClient, sleep=lambda s: None).first()
    assert (r.status, r.attempt, r.n, r.enhanced) == ("success", 1, 2, True)


def test_bad_answers_are_retried():
    class Second:
        n = 0

        def generate(self, prompt, model, timeout=None):
            self.n += 1
            return "prose" if self.n == 1 else '{"a":1} end'
    c = Second()
    assert N.call_with_retries(c, "p", "primary", sleep=lambda s: None) == ('{"a":1} end', None) and c.n == 2
    assert N.call_with_retries(StubClient(), "x" * 11, "primary", sleep=lambda s: None) == ("I cannot answer that.", None)


def test_retries_wait_between_tries():
    waits = []

    class Flaky:
        def __init__(self):
            self.n = 0

        def generate(self, prompt, model, timeout=None):
            self.n += 1
            if self.n < 3:
                raise RuntimeError("503 Service Unavailable")
            return "{}"
    resp, err = N.call_with_retries(Flaky(), "p", "primary", sleep=waits.append)
    assert resp == "{}" and err is None and waits == [4, 4]
    resp, err = N.call_with_retries(StubClient(), "x" * 7, "primary", sleep=waits.append)
    assert resp is None and "503" in err


def test_error_classes(spark):
    errs = ["429 Resource has been exhausted", "Quota exceeded", "API call timed out", "Connection reset",
            "HTTP 502 bad gateway", "weird", None]
    df = spark.createDataFrame([(e,) for e in errs], "e string").select(N.classify_error("e").alias("c"))
    got = [(r.c.error_class, r.c.wait_s, r.c.counts_as_attempt) if r.c else None for r in df.collect()]
    assert got == [("rate_limit", 3600, False), ("rate_limit", 3600, False), ("timeout", 30, True),
                   ("timeout", 30, True), ("server", 60, True), ("other", 5, True), None]


def test_concat_chunks_in_order(spark):
    df = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b"), (2, 0, "z")], "k int, p int, t string")
    out = {r.k: r.response for r in N.concat_chunks(df, "k", "p", "t").collect()}
    assert out == {1: "abc", 2: "z"}


def test_concat_chunks_many_blocks(spark):
    rows = [(7, i, f"{i};") for i in range(2500, -1, -1)]
    df = spark.createDataFrame(rows, "k int, p long, t string").repartition(5)
    r = N.concat_chunks(df, "k", "p", "t", block=100).first()
    assert r.n_chunks == 2501 and r.response == "".join(f"{i};" for i in range(2501))


# ------------------------------------------------- put-off work, block commits

# the clients below travel to the workers with their code
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Limited:
    """Rate-limits every prompt until ``now`` has reached its hour."""

    def __init__(self, now, hours, answer):
        self.now, self.hours, self.answer = now, hours, answer

    def generate(self, prompt, model, timeout=None):
        if self.now < 3600 * self.hours:
            raise RuntimeError("429 Resource has been exhausted")
        if isinstance(self.answer, Exception):
            raise self.answer
        return self.answer


FULL = '{"rootcause":"r","weakness":"w"}'


class _Now:
    """Builds its client with the clock's time when the job is sent."""

    def __init__(self, clock, hours, answer):
        self.clock, self.hours, self.answer = clock, hours, answer

    def __call__(self):
        return Limited(self.clock.t, self.hours, self.answer)


def test_rate_limits_use_up_no_attempt(spark):
    clock, path = StepClock(), scratch_path(spark, "t-limit")
    recs = spark.createDataFrame([("CVE-1", "abc"), ("CVE-2", "abcd")], "cve_id string, description string")
    out = L.run_ladder(recs, path, _Now(clock, 5, FULL), sleep=lambda s: None, clock=clock).collect()
    assert [(r.status, r.attempt, r.model_type, r.n) for r in out] == [("success", 1, "primary", 2)] * 2
    log = N.read_attempts(spark, path)
    assert sorted((r.cve_id, r.attempt, r.deferral, r.made_at) for r in log.collect()) == sorted(
        (i, 1, d, 3600.0 * d) for i in ("CVE-1", "CVE-2") for d in range(6))
    assert clock.waits == [3600.0] * 5
    got = {r.cve_id: (r.counted, r.n_rate_limit, r.next_after_s) for r in L.retry_table(log).collect()}
    assert got == {"CVE-1": (1, 5, None), "CVE-2": (1, 5, None)}


def test_other_errors_use_up_attempts_and_wait(spark):
    clock = StepClock()
    recs = spark.createDataFrame([("CVE-1", "abc")], "cve_id string, description string")
    path = scratch_path(spark, "t-wait")
    out = L.run_ladder(recs, path, _Now(clock, 1, RuntimeError("weird")), sleep=lambda s: None, clock=clock).collect()
    assert [(r.status, r.attempt) for r in out] == [("failed", None)]
    assert clock.waits == [3600.0, 5.0, 5.0]
    r = L.retry_table(N.read_attempts(spark, path)).first()
    assert (r.counted, r.n_rate_limit, r.n_other, r.next_after_s) == (3, 1, 3, 5)


def test_patience_ends_a_run_and_its_id_resumes_it(spark):
    recs = spark.createDataFrame([("CVE-1", "abc"), (None, "no id")], "cve_id string, description string")
    path, clock = scratch_path(spark, "t-patience"), StepClock()
    out = L.run_ladder(recs, path, _Now(clock, 9, FULL), sleep=lambda s: None, clock=clock, patience_s=2 * 3600 + 100).collect()
    assert [(r.status, r.attempt, r.enhanced) for r in out] == [("deferred", None, False)] * 2 and clock.t == 7200
    before = N.read_attempts(spark, path).count()
    clock.t = 9 * 3600
    out = L.run_ladder(recs, path, _Now(clock, 9, FULL), sleep=lambda s: None, clock=clock).collect()
    assert [(r.status, r.attempt) for r in out] == [("success", 1)] * 2
    assert before == 6 and N.read_attempts(spark, path).count() == before + 2  # recorded calls were replayed


def test_a_rate_limited_enhancement_is_put_off(spark):
    class Enhancing:
        def __init__(self, now):
            self.now = now

        def generate(self, prompt, model, timeout=None):
            if "CURRENT KEYPHRASES" not in prompt:
                return '{"rootcause":"r"}'
            if self.now < 7200:
                raise RuntimeError("Quota exceeded")
            return FULL
    clock = StepClock()

    class Made:
        def __init__(self, c):
            self.c = c

        def __call__(self):
            return Enhancing(self.c.t)
    recs = spark.createDataFrame([("CVE-1", "abc")], "cve_id string, description string")
    r = L.run_ladder(recs, scratch_path(spark, "t-enh"), Made(clock), sleep=lambda s: None, clock=clock).first()
    assert (r.status, r.attempt, r.n, r.enhanced, clock.t) == ("success", 1, 2, True, 7200)


def test_reprocess_is_put_off_too(spark):
    clock = StepClock()
    ins = spark.createDataFrame([("CVE-1", 1, '{"rootcause":"r"}'), ("CVE-2", 0, "{}")], "cve_id string, current_count int, content string")
    desc = spark.createDataFrame([("CVE-1", "abc")], "cve_id string, description string")
    res = L.reprocess(ins, desc, scratch_path(spark, "t-rep"), _Now(clock, 3, FULL), sleep=lambda s: None, clock=clock)
    assert sorted((r.cve_id, r.new_count, r.outcome) for r in res.collect()) == [("CVE-1", 2, "improved"), ("CVE-2", None, "failed")]
    assert clock.waits == [3600.0] * 3


class Dying:
    """Notes every call in a file and kills its worker once, at one prompt."""

    def __init__(self, folder):
        self.folder = folder

    def generate(self, prompt, model, timeout=None):
        import os
        import uuid
        number = prompt.rsplit(" ", 1)[1]
        open(f"{self.folder}/{number}-{uuid.uuid4().hex}", "w").close()
        if number == "77" and not os.path.exists(f"{self.folder}/died"):
            open(f"{self.folder}/died", "w").close()
            os._exit(1)
        return FULL


def test_a_lost_worker_repeats_one_block_at_most(spark, tmp_dir):
    import os

    import pytest
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    n, rows, tasks = 240, 10, 2
    recs = spark.createDataFrame([(f"CVE-{i}", f"text {i}") for i in range(n)], "cve_id string, description string").coalesce(1)
    path = scratch_path(spark, "t-dying")

    def run():
        return L.run_ladder(recs, path, lambda: Dying(tmp_dir), concurrency=tasks, sleep=lambda s: None, block_rows=rows).collect()

    with pytest.raises((Py4JJavaError, PySparkException)):
        run()
    made = len(os.listdir(tmp_dir)) - 1
    kept = N.read_attempts(spark, path).count()
    assert kept % (rows * tasks) == 0 and 0 < kept < n and made - kept <= rows * tasks
    assert {r.status for r in run()} == {"success"}
    calls = [f.split("-")[0] for f in os.listdir(tmp_dir) if f != "died"]
    again = len(calls) - len(set(calls))
    assert len(set(calls)) == n and 1 <= again <= rows * tasks
    assert N.read_attempts(spark, path).count() == n


def test_calls_in_flight_are_bounded(spark, tmp_dir):
    class Counting:
        def __init__(self, folder):
            self.folder = folder

        def generate(self, prompt, model, timeout=None):
            import os
            import time
            import uuid
            own = f"{self.folder}/{uuid.uuid4().hex}"
            open(own, "w").close()
            seen = len([f for f in os.listdir(self.folder) if not f.endswith("max")])
            open(f"{self.folder}/{seen}.max", "w").close()
            time.sleep(0.02)
            os.remove(own)
            return FULL
    import os
    recs = spark.createDataFrame([(f"CVE-{i}", "t") for i in range(40)], "cve_id string, description string").repartition(4)
    L.run_ladder(recs, scratch_path(spark, "t-flight"), lambda: Counting(tmp_dir), concurrency=2, sleep=lambda s: None, block_rows=5).collect()
    assert max(int(f.split(".")[0]) for f in os.listdir(tmp_dir)) <= 2


def test_blocks_without_a_cap_are_tasks_of_one_job(spark):
    """The number of jobs doesn't grow with the number of calls."""
    recs = spark.createDataFrame([(f"CVE-{i}", f"text {i}") for i in range(600)], "cve_id string, description string")
    path, sc = scratch_path(spark, "t-jobs"), spark.sparkContext
    sc.setJobGroup("ladder-jobs", "")
    try:
        L.run_ladder(recs, path, lambda: _Full(), sleep=lambda s: None, block_rows=5).collect()
        jobs = len(sc.statusTracker().getJobIdsForGroup("ladder-jobs"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20
    log = N.read_attempts(spark, path)
    files = log.select(F.col("_metadata.file_path").alias("f")).groupBy("f").count()
    assert log.count() == 600 and files.count() >= 600 // 5 and files.agg(F.max("count")).first()[0] <= 8
    assert "prompt" not in [c.split()[0] for c in L.STEP.split(", ")]  # as long as the description: not stored, not shuffled


class _Full:
    def generate(self, prompt, model, timeout=None):
        return FULL


def test_a_dead_run_keeps_the_tasks_that_ended(spark, tmp_dir):
    import os

    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    n, rows = 240, 10
    recs = spark.createDataFrame([(f"CVE-{i}", f"text {i}") for i in range(n)], "cve_id string, description string")
    path = scratch_path(spark, "t-dead")

    def run():
        return L.run_ladder(recs, path, lambda: Dying(tmp_dir), sleep=lambda s: None, block_rows=rows).collect()

    try:
        run()
    except (Py4JJavaError, PySparkException):
        pass
    assert {r.status for r in run()} == {"success"}
    calls = [f.split("-")[0] for f in os.listdir(tmp_dir) if f != "died"]
    assert len(set(calls)) == n and len(calls) - n <= 2 * rows * spark.sparkContext.defaultParallelism
    assert N.read_attempts(spark, path).count() == n == N.read_attempts(spark, path).select("cve_id").distinct().count()


def test_answers_reach_python_in_small_batches(spark):
    """A worker holds few texts at a time, however many rows a partition has."""
    recs = spark.range(5000).selectExpr("concat('CVE-', id) AS cve_id", "1 AS attempt", "'extract' AS call", "'primary' AS model",
                                        "repeat('x', 10000) AS description", "repeat('x', 10000) AS prompt").coalesce(1)

    def biggest(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])
    got = recs.mapInArrow(biggest, "n long, size long").agg(F.max("n"), F.max("size")).first()
    assert got[0] <= 1000 and got[1] < 20 << 20
    out = N.infer(recs, lambda: _Full(), sleep=lambda s: None)
    assert out.agg(F.count("*"), F.sum(F.length("description")), F.min("response")).first() == (5000, 50000000, FULL)
