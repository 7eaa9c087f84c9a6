"""Batch model inference as a Spark job around a pluggable client.

Prompts are built with column expressions, the external call runs in one
``mapInArrow`` stage (one client per partition, bounded concurrency, inner
retries), and answers are *written* to an ``attempts`` table before any
branch reads them, so a paid call is never repeated by re-evaluation. Prompts
are cut into blocks, and a task's answers to a block are committed before it
takes the next one: a lost task or a dead run repeats calls of one block a task
at most. A call
is keyed by ``(run, cve_id, attempt, call, deferral)``; calls already in the
table are not made again when a run resumes, and a later run calls anew what
failed. The ladder over these calls is in ``ladder``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import jsonx as J
from skein.functions.built import built_once
from skein.operators.layout import balance, fence
from skein.session import path_exists, scratch_path

# --- fixed values -----------------------------------------------------------
PRIMARY = "primary"
FALLBACK = "fallback"
# Instruction placed before the description in extraction prompts.
EXTRACT_INSTRUCTION = ("<INSTRUCTION>Only use these json fields:rootcause, weakness, impact, "
                       "vector, attacker, product, version, component</INSTRUCTION>")
# Error text -> (class, wait seconds, consumes an attempt); checked in order.
RATE_LIMIT_TEXT = "429 Resource has been exhausted"
RATE_LIMIT_WORD = "quota"
TIMEOUT_WORDS = ("timeout", "connection")
TIMEOUT_TEXTS = ("TimeoutError", "API call timed out")
SERVER_CODES = ("500", "502", "503", "504")
WAITS = {"rate_limit": 3600, "timeout": 30, "server": 60, "other": 5}
MAX_ATTEMPTS = 3
INNER_TRIES = 3
BACKOFF_MIN_S, BACKOFF_MAX_S = 4, 10
CALL_TIMEOUT_S = 300
BLOCK_ROWS = 200  # calls that a task makes before they are committed
ROWS_AT_ONCE = 1 << 16  # equal routed rows made from one array
# ---------------------------------------------------------------------------

# Enhancement prompt (our wording): current fields, description, task.
ENHANCE_HEAD = ("<INSTRUCTION>\nReview the keyphrases already extracted for the vulnerability "
                "description below and improve them.\nKeep entries that are right, correct wrong "
                "or partial ones, and fill every field the description supports;\nleave a field "
                "empty only when the description says nothing about it.\n\nCURRENT KEYPHRASES:\n")
ENHANCE_MID = "\n\nDESCRIPTION:\n"
ENHANCE_TAIL = ("\n\nAnswer with one JSON object holding only these fields: rootcause, weakness, "
                "impact, vector, attacker, product, version, component\n</INSTRUCTION>")

CALL_SCHEMA = ("cve_id string, attempt int, call string, model string, description string, "
               "prompt_chars int, response string, error string, deferral int, carried string, made_at double")


@built_once
def build_prompt(desc) -> Column:
    return F.concat(F.lit(EXTRACT_INSTRUCTION), desc if isinstance(desc, Column) else F.col(desc))


@built_once
def build_enhance_prompt(desc, current_json) -> Column:
    d = desc if isinstance(desc, Column) else F.col(desc)
    j = current_json if isinstance(current_json, Column) else F.col(current_json)
    return F.concat(F.lit(ENHANCE_HEAD), j, F.lit(ENHANCE_MID), d, F.lit(ENHANCE_TAIL))


@built_once
def classify_error(err) -> Column:
    """STRUCT<error_class, wait_s, counts_as_attempt> for an error text."""
    e = err if isinstance(err, Column) else F.col(err)
    low = F.lower(e)
    rate = e.contains(RATE_LIMIT_TEXT) | low.contains(RATE_LIMIT_WORD)
    tmo = F.lit(False)
    for w in TIMEOUT_WORDS:
        tmo = tmo | low.contains(w)
    for t in TIMEOUT_TEXTS:
        tmo = tmo | e.contains(t)
    srv = F.lit(False)
    for c in SERVER_CODES:
        srv = srv | e.contains(c)
    cls = (F.when(rate, F.lit("rate_limit")).when(tmo, F.lit("timeout"))
           .when(srv, F.lit("server")).otherwise(F.lit("other")))
    wait = (F.when(rate, F.lit(WAITS["rate_limit"])).when(tmo, F.lit(WAITS["timeout"]))
            .when(srv, F.lit(WAITS["server"])).otherwise(F.lit(WAITS["other"])))
    return F.when(e.isNotNull(), F.struct(cls.alias("error_class"), wait.alias("wait_s"),
                                          (~rate).alias("counts_as_attempt")))


def concat_chunks(chunks: DataFrame, key: str, pos: str, text: str, block: int = 1024) -> DataFrame:
    """Response text per key: chunks concatenated in position order.

    Two-level: chunks are first joined within blocks of ``block``
    consecutive positions (``(key, pos div block)`` groups, spread over many
    tasks, each sorting at most ``block`` rows), then the block strings are
    joined per key. A key with a huge number of chunks therefore does not
    sort all of them in one task; only its (inherently single) result row
    is assembled in one place."""
    def joined(order, value):
        srt = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
        return F.array_join(F.transform(srt, lambda x: x["v"]), "")
    blk = F.floor(F.col(pos) / F.lit(block)).alias("__blk")
    parts = chunks.groupBy(key, blk).agg(joined(pos, text).alias("__part"),
                                         F.count(F.lit(1)).alias("__n"))
    return parts.groupBy(key).agg(F.sum("__n").cast("bigint").alias("n_chunks"),
                                  joined("__blk", "__part").alias("response"))


# ------------------------------------------------------------- the call ---

def usable_answer(text: str) -> bool:
    """Strict JSON, as it is or cut after its last closing brace."""
    body = text.strip()
    for t in (text, body[:body.rfind("}") + 1] if body.startswith("{") else ""):
        try:
            json.loads(t)
            return True
        except ValueError:
            pass
    return False


def call_with_retries(client, prompt: str, model: str, tries: int = INNER_TRIES,
                      sleep: Callable[[float], None] = time.sleep,
                      timeout: float = CALL_TIMEOUT_S,
                      accept: Callable[[str], bool] = usable_answer) -> tuple[str | None, str | None]:
    """Up to ``tries`` calls with exponential waits between 4 and 10 s, until
    an answer is accepted: a sampling model may answer better the next time.
    The last answer is kept when none is; the timeout is handed to the client
    (signals do not work on executors)."""
    answer, err = None, None
    for i in range(tries):
        try:
            answer, err = client.generate(prompt, model, timeout=timeout), None
            if accept(answer):
                break
        except Exception as e:  # the error text is data: it is classified later
            err = str(e) or type(e).__name__
        if i + 1 < tries:
            sleep(min(max(2 ** (i + 1), BACKOFF_MIN_S), BACKOFF_MAX_S))
    return (answer, None) if answer is not None else (None, err)


def infer(prompts: DataFrame, client_factory: Callable[[], object],
          concurrency: int | None = None, tries: int = INNER_TRIES,
          sleep: Callable[[float], None] = time.sleep, now: Callable[[], float] | None = None) -> DataFrame:
    """One model call per row of ``prompts(cve_id, attempt, call, model,
    description, prompt)`` -> ``CALL_SCHEMA`` rows. ``deferral`` and ``carried``
    are handed through where present. ``made_at`` is what ``now`` says on the
    worker when the call is begun.

    ``concurrency`` caps the number of simultaneous calls (partitions); the
    client is built once per partition from a picklable factory.
    """
    extra = [(F.col("deferral") if "deferral" in prompts.columns else F.lit(0)).cast("int").alias("deferral"),
             F.col("carried") if "carried" in prompts.columns else F.lit(None).cast("string").alias("carried")]
    df = prompts.select("cve_id", F.col("attempt").cast("int").alias("attempt"), "call", "model", "description", "prompt", *extra)
    df = df.repartition(concurrency) if concurrency else balance(df)

    def run(batches):
        client = client_factory()
        for b in batches:
            answers, errors, chars, made = [], [], [], []
            for p, m in zip(b.column("prompt"), b.column("model")):  # one text at a time; the others stay in Arrow
                p = p.as_py()
                made.append(now() if now else None)
                r, e = call_with_retries(client, p, m.as_py(), tries=tries, sleep=sleep) if p is not None else (None, "no prompt")
                answers.append(r)
                errors.append(e)
                chars.append(len(p) if p is not None else 0)
            own = {"prompt_chars": pa.array(chars, pa.int32()), "response": pa.array(answers, pa.string()),
                   "error": pa.array(errors, pa.string()), "made_at": pa.array(made, pa.float64())}
            names = [c.split()[0] for c in CALL_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([own[n] if n in own else b.column(n) for n in names], names)
    return df.mapInArrow(run, CALL_SCHEMA)


def parse_calls(calls: DataFrame) -> DataFrame:
    """Add ``json`` (repaired strict JSON text or null), ``ok`` and ``n``
    (non-empty field count; 0 for a non-object answer).

    Repair, parse and count each run once per row (``fence``): later
    filters on ``ok`` / ``n`` must not copy the parse into themselves."""
    j = fence(calls.select("*", J.repair_response("response").alias("json")))
    m = fence(j.select("*", J.parse_object("json").alias("__m")))
    n = F.when(F.col("json").isNotNull(), F.coalesce(J.nonempty_count("__m"), F.lit(0)))
    err = F.coalesce(F.col("error"), F.when(F.col("json").isNull(), F.lit("Invalid JSON response")))
    cols = [c for c in calls.columns if c != "error"]
    return fence(m.select(*cols, err.alias("error"), "json", F.col("json").isNotNull().alias("ok"),
                          n.alias("n")))


def read_calls(spark, attempts_path: str, keys, run_id: str) -> DataFrame:
    """Recorded calls of the given ``(attempt, call)`` passes of one run.

    The attempts table is partitioned by ``run``, ``call`` and ``attempt``, so the
    filter prunes whole partitions: a pass reads its own slice of the
    history, not every call ever made."""
    cond = None
    for a, c in keys:
        k = (F.col("call") == c) & (F.col("attempt") == a)
        cond = k if cond is None else cond | k
    return read_attempts(spark, attempts_path).filter((F.col("run") == run_id) & cond)


def read_attempts(spark, attempts_path: str) -> DataFrame:
    """The attempts table, read by its known schema."""
    return spark.read.schema(CALL_SCHEMA + ", run string").parquet(attempts_path)


def _same_call(left: DataFrame, keys: DataFrame) -> Column:
    return (left["cve_id"].eqNullSafe(keys["__id"]) & (left["attempt"] == keys["__a"])
            & (left["call"] == keys["__c"]) & (F.coalesce(left["deferral"], F.lit(0)) == keys["__d"]))


def _keys(df: DataFrame) -> DataFrame:
    return df.select(F.col("cve_id").alias("__id"), F.col("attempt").alias("__a"), F.col("call").alias("__c"),
                     F.coalesce("deferral", F.lit(0)).alias("__d"))


def calls_of(due: DataFrame, calls: DataFrame) -> DataFrame:
    """The recorded calls of the work that is due (calls of other ids stay in
    the table but are not part of this run's outcome)."""
    k = _keys(due)
    return calls.join(k, _same_call(calls, k), "left_semi")


def append_calls(work: DataFrame, keys, attempts_path: str, run_id: str, client_factory, concurrency, tries, sleep,
                 now: Callable[[], float] = time.time, block_rows: int = BLOCK_ROWS, at_most: int | None = None,
                 prompted: Callable[[DataFrame], DataFrame] = lambda df: df, recorded: bool = True) -> None:
    """Make the calls this run has not recorded yet and append them to the
    attempts table, block by block.

    ``keys`` lists the ``(attempt, call)`` passes the work belongs to; only
    those partitions are read for the "already called" anti-join, and none if
    nothing is ``recorded`` under the run's id yet. Another run's calls don't
    count: what failed then is tried again now. ``prompted`` adds the prompt,
    which is as long as the description: it is built where it is sent.

    With a cap on ``concurrency``, a block holds ``block_rows`` prompts of each
    of its tasks and is one job: its answers are committed when all of them are
    in, and only then the next block is called. Without one, a task is a block
    of about ``block_rows`` prompts, all in one job: a task's answers are put in
    place as it ends (the second version of Hadoop's commit), and only as many
    tasks run at a time as there are cores. ``at_most`` bounds the number of
    prompts, if it is known: what fits one block isn't written first."""
    spark = work.sparkSession
    todo = work
    if recorded and path_exists(spark, attempts_path):
        done = _keys(read_calls(spark, attempts_path, keys, run_id))
        todo = work.join(done, _same_call(work, done), "left_anti")
    tasks = concurrency or spark.sparkContext.defaultParallelism

    def commit(block: DataFrame, spread: int = tasks, by_task: bool = False) -> None:
        (infer(prompted(block.repartition(spread)), client_factory, None, tries, sleep, now).withColumn("run", F.lit(run_id)).write.mode("append")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2" if by_task else "1")
         .partitionBy("run", "call", "attempt").parquet(attempts_path))

    if not concurrency:
        n = todo.count() if at_most is None else at_most
        # rows are dealt evenly but not exactly so: a tenth more tasks than needed
        commit(todo, max(1, min(n, tasks), -(-n * 11 // (block_rows * 10))), by_task=True)
        return
    if at_most is not None and at_most <= block_rows * tasks:
        commit(todo)
        return
    # a row's place in its partition numbers its block
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    path = scratch_path(spark, "prompts")
    todo.repartition(tasks).withColumn("block", F.floor(place / block_rows).cast("long")).write.partitionBy("block").parquet(path)
    blocks = spark.read.schema(todo.schema.add("block", "long")).parquet(path)
    for number in sorted(r["block"] for r in blocks.select("block").distinct().collect()):
        # small files of a block would be read by one task: each task calls its share
        commit(blocks.filter(F.col("block") == number).drop("block"))


def ladder_from_attempts(attempts: DataFrame) -> DataFrame:
    """Outcome per id from a recorded attempts table ``(cve_id, attempt,
    model, response, error)``: the first attempt whose answer parses wins."""
    parsed = parse_calls(attempts.withColumn("call", F.lit("extract")))
    first = (parsed.groupBy("cve_id").agg(
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("win"),
        F.max("attempt").alias("tried")))
    return first.select("cve_id", F.when(F.col("win").isNotNull(), F.lit("success")).otherwise(F.lit("failed")).alias("status"),
                        F.col("win").alias("attempt"),
                        F.when(F.col("win") == 1, F.lit(PRIMARY)).when(F.col("win").isNotNull(), F.lit(FALLBACK))
                        .alias("model_type"))


def run_stats(outcome: DataFrame) -> DataFrame:
    """successful, failed, via primary, via fallback, total."""
    s = F.col("status")
    return outcome.agg(
        F.count_if(s == "success").cast("bigint").alias("successful"),
        F.count_if(s == "failed").cast("bigint").alias("failed"),
        F.count_if((s == "success") & (F.col("model_type") == PRIMARY)).cast("bigint").alias("via_primary"),
        F.count_if((s == "success") & (F.col("model_type") == FALLBACK)).cast("bigint").alias("via_fallback"),
        F.count(F.lit(1)).cast("bigint").alias("total"))


def latest_errors(attempts: DataFrame) -> DataFrame:
    """Latest error per id (error records overwrite earlier ones)."""
    e = attempts.filter(F.col("error").isNotNull())
    last = F.max_by(F.struct("attempt", "model", "error"), "attempt")
    return e.groupBy("cve_id").agg(last.alias("l")).select("cve_id", "l.attempt", "l.model", "l.error")


def route_outcomes(attempts: DataFrame) -> DataFrame:
    """Route each recorded call up to the winning one: ``success`` (the
    winning answer), ``error`` (a failed call) and one ``failed`` row for
    ids that never succeeded.

    One scan and one parse a call. Calls are counted by (id, attempt, route) as
    they are read, before anything is shuffled, so an id with very many calls
    sends one row a task and its array has at most two entries an attempt. The
    rows are made again from the counts, in blocks that are dealt over all
    tasks."""
    parsed = parse_calls(attempts.withColumn("call", F.lit("extract")))
    route = F.when(F.col("ok"), F.lit("success")).otherwise(F.lit("error")).alias("route")
    calls = parsed.select("cve_id", "attempt", route)
    g = calls.groupBy("cve_id", "attempt", "route").agg(F.count("*").alias("times")).groupBy("cve_id").agg(
        F.min(F.when(F.col("route") == "success", F.col("attempt"))).alias("win"),
        F.collect_list(F.struct("attempt", "route", "times")).alias("calls"))
    upto = F.filter("calls", lambda c: F.col("win").isNull() | (c["attempt"] <= F.col("win")))
    end = F.when(F.col("win").isNull(), F.array(F.struct(F.lit(None).cast("int").alias("attempt"), F.lit("failed").alias("route"), F.lit(1).cast("bigint").alias("times"))))
    rows = F.concat(upto, F.coalesce(end, F.slice(upto, 1, 0)))
    r = g.select("cve_id", F.explode(rows).alias("r")).select("cve_id", "r.*")
    # blocks of ROWS_AT_ONCE rows, so no array holds all rows of a call
    r = r.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(times - 1) div {ROWS_AT_ONCE}"))).alias("block"))
    r = r.repartition("cve_id", "attempt", "route", "block")
    size = F.least(F.lit(ROWS_AT_ONCE).cast("bigint"), F.col("times") - F.col("block") * ROWS_AT_ONCE).cast("int")
    return r.select("cve_id", "attempt", "route", F.explode(F.array_repeat(F.lit(1), size))).select("cve_id", "attempt", "route")


def reprocess_stats(res: DataFrame) -> DataFrame:
    o = F.col("outcome")
    return res.agg(F.count_if(o == "improved").cast("bigint").alias("improved"),
                   F.count_if(o == "failed").cast("bigint").alias("failed"),
                   F.count(F.lit(1)).cast("bigint").alias("total"))


def upsert_if_better(current: DataFrame, res: DataFrame, key: str = "cve_id") -> DataFrame:
    """Keyed upsert: improved answers replace the current docs (full outer
    join on the key); everything else keeps its content."""
    imp = res.filter(F.col("outcome") == "improved").select(F.col(key).alias("__k"), F.col("json").alias("__new"))
    c = current.select(F.col(key).alias("__c"), F.col("content").alias("__old"))
    j = c.join(imp, c["__c"] == imp["__k"], "full_outer")
    return j.select(F.coalesce("__c", "__k").alias(key), F.coalesce("__new", "__old").alias("content"),
                    F.col("__new").isNotNull().alias("updated"))
