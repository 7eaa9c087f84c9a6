"""Fallback ladder as an attempt state machine over deferred work.

A run holds a table of *work*: one row per call that is due now or later, with
its attempt number, its ``not_before`` time and how often it was put off. A
round takes the work that is due, makes the calls block by block, reads the
recorded answers back and writes each row's next state once: done, or new work.

* An answer ends the work, or asks for one enhancement call.
* A rate limit uses up no attempt: the same call is due again after the class's
  wait, with its ``deferral`` raised.
* Another error uses up an attempt; the next one is due after its class's wait.
  An answer that can't be read does, too, and its next attempt is due at once.

Nothing waits for one record: while some work is put off, what is due goes on,
and the driver sleeps only when nothing is. The attempts table is the journal:
a run resumed under its id replays its recorded calls and makes the others.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import jsonx as J
from skein.operators import infer as N
from skein.operators.layout import fence
from skein.session import path_exists, scratch_path

GRACE_S = 60.0  # work due within this time is waited for and done in one round

WORK = ("cve_id string, description string, attempt int, call string, model string, "
        "deferral int, carried string, not_before double")
DONE = "status string, model_type string, json string, n int, enhanced boolean"
STEP = f"{WORK}, {DONE}, kind string"


class Clock:
    """Time as the run sees it. ``sleep`` may return early or at once (tests,
    replays): the time asked for counts as passed."""

    def __init__(self, sleep: Callable[[float], None] = time.sleep):
        self._sleep, self._ahead = sleep, 0.0

    def now(self) -> float:
        return time.time() + self._ahead

    def wait(self, seconds: float) -> None:
        began = time.time()
        self._sleep(seconds)
        self._ahead += max(0.0, seconds - (time.time() - began))


def work_rows(df: DataFrame, attempt, call: str, model: str, carried=None,
              not_before: Column | None = None, deferral: Column | None = None) -> DataFrame:
    """Rows of ``WORK`` from ``df(cve_id, description)``."""
    a = attempt if isinstance(attempt, Column) else F.lit(attempt)
    return df.select("cve_id", "description", a.cast("int").alias("attempt"), F.lit(call).alias("call"), F.lit(model).alias("model"),
                     F.coalesce(deferral if deferral is not None else F.lit(0)).cast("int").alias("deferral"),
                     (F.col(carried) if carried else F.lit(None).cast("string")).alias("carried"),
                     (not_before if not_before is not None else F.lit(0.0)).cast("double").alias("not_before"))


def _state(calls: DataFrame) -> DataFrame:
    """Parsed calls with ``limited`` (put off, no attempt used up) and
    ``again_at``, when a call after this one is due."""
    p = N.parse_calls(calls.withColumn("raw_error", F.col("error")))
    p = p.select("*", N.classify_error("raw_error").alias("__c"))
    return fence(p.selectExpr("*", "coalesce(NOT __c.counts_as_attempt, false) AS limited", "made_at + coalesce(__c.wait_s, 0) AS again_at"))


# the next state of a call, over the columns that ladder_step prepares
_NEXT = f"""cve_id
CASE WHEN again THEN description END AS description
CASE WHEN retry THEN attempt + 1 ELSE attempt END AS attempt
CASE WHEN enhance THEN 'enhance' WHEN again THEN 'extract' END AS call
CASE WHEN limited THEN model WHEN again THEN '{N.FALLBACK}' END AS model
CASE WHEN limited THEN deferral + 1 ELSE 0 END AS deferral
CASE WHEN enhance THEN base END AS carried
CASE WHEN ask THEN 0D ELSE again_at END AS not_before
CASE WHEN NOT again THEN CASE WHEN won THEN 'success' ELSE 'failed' END END AS status
CASE WHEN NOT again AND won THEN CASE WHEN attempt = 1 THEN '{N.PRIMARY}' ELSE '{N.FALLBACK}' END END AS model_type
CASE WHEN NOT again AND won THEN CASE WHEN extract OR better THEN json ELSE base END END AS json
CASE WHEN NOT again AND won THEN CASE WHEN extract OR better THEN n ELSE had END END AS n
better AS enhanced
CASE WHEN again THEN 'work' ELSE 'done' END AS kind""".splitlines()


def ladder_step(calls: DataFrame, max_attempts: int) -> DataFrame:
    """``STEP`` rows: the next state of each recorded call of the ladder. One
    row in, one row out: an answer is read and parsed once."""
    p = _state(calls).selectExpr("*", "call = 'extract' AS extract", "call = 'extract' AND ok AND attempt = 1 AND n <= 1 AS ask",
                                 f"call = 'extract' AND NOT ok AND NOT limited AND attempt < {max_attempts} AS retry")
    p = p.selectExpr("*", "ask OR (limited AND NOT extract) AS enhance", "limited OR ask OR retry AS again", "NOT extract OR ok AS won",
                     "CASE WHEN ask THEN json ELSE carried END AS base")
    p = fence(p.select("*", F.when(F.expr("NOT extract"), J.parse_object("base")).alias("__b")))
    # the enhancement counts only with strictly more fields
    p = p.select("*", J.nonempty_count("__b").alias("__had"))
    p = fence(p.selectExpr("*", "coalesce(__had, 0) AS had", "NOT extract AND ok AND n > coalesce(__had, 0) AS is_more"))
    p = p.select("*", F.expr("coalesce(is_more, false) AS better"))
    return p.selectExpr(*_NEXT)


def ladder_prompts(work: DataFrame) -> DataFrame:
    """``work`` with its prompts. An answer to be enhanced that isn't an object
    is shown to the model as it is."""
    p = fence(work.select("*", F.when(F.col("call") == "enhance", J.parse_object("carried")).alias("__b")))
    p = p.select("*", F.coalesce(J.text_map_to_json("__b"), F.col("carried")).alias("shown"))
    return p.select("*", F.when(F.col("call") == "enhance", N.build_enhance_prompt("description", "shown"))
                    .otherwise(N.build_prompt("description")).alias("prompt"))


def run_rounds(work: DataFrame, prompted: Callable[[DataFrame], DataFrame], step: Callable[[DataFrame], DataFrame], attempts_path: str, run_id: str, client_factory,
               concurrency: int | None, tries: int, sleep: Callable[[float], None], clock: Clock,
               patience_s: float | None, block_rows: int) -> DataFrame:
    """``STEP`` rows at the end of the run: ``done``, and as ``work`` what is
    still put off when ``patience_s`` seconds have passed (None: none is).
    ``prompted`` adds the prompts of the calls that are due.

    Recorded calls are matched with the work only where others than its own may
    stand under the same passes: in a run taken up again, and in a pass that an
    earlier round made calls of. Otherwise no text is shuffled for it."""
    spark: SparkSession = work.sparkSession
    root = scratch_path(spark, "ladder")
    began, k = clock.now(), 0
    resumed = path_exists(spark, attempts_path) and not N.read_attempts(spark, attempts_path).filter(F.col("run") == run_id).isEmpty()
    called: set = set()

    def write(df: DataFrame) -> DataFrame:
        """One version of the state, read back by kind."""
        names = [c.split()[0] for c in STEP.split(", ")]
        have = set(df.columns)
        kinds = dict(c.split() for c in STEP.split(", "))
        df.select(*[F.col(c) if c in have else F.lit(None).cast(kinds[c]).alias(c) for c in names]) \
            .write.partitionBy("kind").parquet(f"{root}/round={k}")
        return rounds().filter(F.col("round") == k)

    def rounds() -> DataFrame:
        return spark.read.schema(f"{STEP}, round int").parquet(root)

    state = write(work.withColumn("kind", F.lit("work")))
    while True:
        left = state.filter("kind = 'work'")
        now = clock.now()
        soon = F.col("not_before") <= now + GRACE_S
        s = left.agg(F.count("*").alias("n"), F.count_if(soon).alias("due"), F.min("not_before").alias("first"),
                     F.max(F.when(soon, F.col("not_before"))).alias("last_due"),
                     F.collect_set(F.when(soon, F.struct("attempt", "call"))).alias("keys")).first()
        if not s["n"]:
            break
        until = s["last_due"] if s["due"] else s["first"]
        if patience_s is not None and until - began > patience_s:
            break
        if until > now:
            clock.wait(until - now)
        if not s["due"]:
            continue
        due, keys = left.filter(soon), sorted({(r["attempt"], r["call"]) for r in s["keys"]})
        N.append_calls(due, keys, attempts_path, run_id, client_factory, concurrency, tries, sleep, clock.now, block_rows, s["due"],
                       prompted, resumed)
        calls = N.read_calls(spark, attempts_path, keys, run_id)
        if resumed or called.intersection(keys):
            calls = N.calls_of(due, calls)
        called.update(keys)
        k += 1
        state = write(step(calls).unionByName(left.filter(~soon).drop("round"), allowMissingColumns=True))
    return rounds().filter((F.col("kind") == "done") | (F.col("round") == k))


def run_ladder(records: DataFrame, attempts_path: str, client_factory, run_id: str = "run",
               concurrency: int | None = None, tries: int = N.INNER_TRIES,
               sleep: Callable[[float], None] = time.sleep, max_attempts: int = N.MAX_ATTEMPTS,
               clock: Clock | None = None, patience_s: float | None = None, block_rows: int = N.BLOCK_ROWS) -> DataFrame:
    """Extraction with quality gate and fallback ladder.

    Attempt 1 uses the primary model; a success with at most one field
    gets one enhancement call (fallback model, enhancement prompt), whose
    answer is taken only when it has strictly more fields. Attempts 2..3
    use the fallback model on the ids still failing. Returns the outcome
    per record: ``cve_id, status, attempt, model_type, json, n, enhanced``;
    status is ``success``, ``failed`` or, after ``patience_s`` seconds of rate
    limits, ``deferred``.

    Calls are recorded under ``run_id``: a run resumed under its id makes no
    recorded call again, a new run tries again what failed before. Of a run
    that is cut off, at most one block of calls (``block_rows`` for each of the
    ``concurrency`` tasks, or of the tasks that the cores run at a time) is not
    recorded yet.
    """
    recs = records.select("cve_id", "description")
    work = work_rows(recs, 1, "extract", N.PRIMARY)
    end = run_rounds(work, ladder_prompts, lambda calls: ladder_step(calls, max_attempts), attempts_path, run_id, client_factory,
                     concurrency, tries, sleep, clock or Clock(sleep), patience_s, block_rows)
    put_off = F.col("kind") == "work"
    return end.select("cve_id", F.when(put_off, "deferred").otherwise(F.col("status")).alias("status"),
                      F.when(~put_off & (F.col("status") == "success"), F.col("attempt")).alias("attempt"), "model_type", "json", "n",
                      F.coalesce("enhanced", F.lit(False)).alias("enhanced"))


def reprocess(insufficient: DataFrame, descriptions: DataFrame, attempts_path: str, client_factory, run_id: str = "run",
              concurrency: int | None = None, tries: int = N.INNER_TRIES, sleep: Callable[[float], None] = time.sleep,
              clock: Clock | None = None, patience_s: float | None = None, block_rows: int = N.BLOCK_ROWS) -> DataFrame:
    """Enhance docs with at most one field: ``insufficient(cve_id,
    current_count, content)`` joined to ``descriptions(cve_id,
    description)``; one fallback call with the enhancement prompt, put off at a
    rate limit; the answer replaces the doc only when it has strictly more
    fields. Output: ``cve_id, current_count, new_count, outcome, json``; what
    is still put off after ``patience_s`` has the outcome ``deferred``."""
    j = insufficient.join(descriptions.select("cve_id", "description"), "cve_id", "left")
    missing = j.filter(F.col("description").isNull()).select(
        "cve_id", "current_count", F.lit(None).cast("int").alias("new_count"),
        F.lit("failed").alias("outcome"), F.lit(None).cast("string").alias("json"))
    have = j.filter(F.col("description").isNotNull())
    work = work_rows(have.select("cve_id", "description", F.col("content").alias("carried")), 0, "reprocess", N.FALLBACK, "carried")

    def prompted(due: DataFrame) -> DataFrame:
        return due.select("*", N.build_enhance_prompt("description", "carried").alias("prompt"))

    def step(calls: DataFrame) -> DataFrame:
        again = F.col("limited")
        return _state(calls).select(
            "cve_id", "attempt", "call", "model", (F.col("deferral") + 1).alias("deferral"), F.col("again_at").alias("not_before"),
            F.when(again, F.col("description")).alias("description"), F.when(again, F.col("carried")).alias("carried"),
            F.when(~again, F.when(F.col("ok"), "success").otherwise("failed")).alias("status"), "json", "n",
            F.when(again, "work").otherwise("done").alias("kind"))

    end = run_rounds(work, prompted, step, attempts_path, run_id, client_factory, concurrency, tries, sleep, clock or Clock(sleep), patience_s, block_rows)
    r = have.select("cve_id", "current_count").join(end.select("cve_id", "kind", "status", "n", "json"), "cve_id", "left")
    outcome = (F.when(F.col("kind") == "work", "deferred").when(~F.coalesce(F.col("status") == "success", F.lit(False)), "failed")
               .when(F.col("n") > F.col("current_count"), "improved").otherwise("no_improvement"))
    done = r.select("cve_id", "current_count", F.col("n").alias("new_count"), outcome.alias("outcome"),
                    F.when(outcome == "improved", F.col("json")).alias("json"))
    return done.unionByName(missing)


def retry_table(attempts: DataFrame) -> DataFrame:
    """What the journal says of each id: calls that used up an attempt and
    calls that failed, by class of error, and for ids whose last call failed the
    seconds after it at which the next one is due. One partial aggregation:
    a task hands on one row an id."""
    c = N.classify_error("error")
    rows = attempts.select("cve_id", "attempt", F.coalesce("deferral", F.lit(0)).alias("deferral") if "deferral" in attempts.columns else F.lit(0).alias("deferral"),
                           c["error_class"].alias("cls"), c["wait_s"].alias("wait_s"), F.coalesce(c["counts_as_attempt"], F.lit(True)).alias("counts"))
    return rows.groupBy("cve_id").agg(
        F.count_if("counts").alias("counted"),
        *[F.count_if(F.col("cls") == k).alias(f"n_{k}") for k in N.WAITS],
        F.max_by("wait_s", F.struct("attempt", "deferral")).cast("long").alias("next_after_s"))
