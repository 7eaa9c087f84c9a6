"""Run modes: the four jobs of the pipeline and their sequence.

Stage tables live under one ``base`` folder (a shared filesystem path):

    source/            delimited source records (input)
    store/             published records, JSON lines by year=/bucket=
    descriptions/      first description per id            (parquet)
    staged/            staged keyphrase docs (file_name, content)
    invalid/           quarantined docs with their issues
    fixed/             repaired docs
    attempts/          every model call (append-only, by run)
    description/, keyphrases/, technical_impacts/
                       raw stage docs, one file a doc (input, each optional)
    merged/            merged records (parquet)
    store_manifest/    ids and hashes of the published records, by year=/bucket=
    publish_note/, publish_partitions/
                       left by a publish that was cut off; the next one clears them
    journal/<run>/     the steps that a run has done
    reports/<name>/    run reports as small tables

Every stage writes a new table before the next stage reads it, so a lost
executor only re-runs the stage it was in, and lineage stays short.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skein.functions import ids as I
from skein.operators import infer as N
from skein.operators import ladder as L
from skein.operators import ingest, manifest, merge, publish, repair, validate
from skein.plans.journal import Journal, NoJournal
from skein.session import configure, path_exists
from skein.sources import files as S


@dataclass
class Paths:
    base: str
    source: str | None = None
    extra: dict = field(default_factory=dict)
    legacy_store: str | None = None   # records published elsewhere, one JSON doc a file
    csv_multiline: bool = True        # False where no source field holds a newline: the files are split

    def __getattr__(self, name):
        if name in ("base", "source", "extra", "legacy_store", "csv_multiline"):
            raise AttributeError(name)
        return f"{self.base.rstrip('/')}/{name}"

    def src(self) -> str:
        return self.source or f"{self.base.rstrip('/')}/source"

    def report(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/reports/{name}"


def _read(spark, path) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def _report(df: DataFrame, path: str) -> None:
    """A per-row report: as many files as tasks."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _report_row(df: DataFrame, path: str) -> None:
    """A report of one row (counts): one file."""
    _report(df.coalesce(1), path)


def read_store(spark: SparkSession, p: Paths) -> DataFrame | None:
    """Published records as text with their id and partition; the schema is
    known, so nothing is inferred from the data."""
    if not path_exists(spark, p.store):
        return None
    return spark.read.text(p.store).select("year", "bucket", "value", F.get_json_object("value", "$.cveId").alias("cve_id"))


def legacy_path(spark: SparkSession, p: Paths) -> str | None:
    return p.legacy_store if p.legacy_store and path_exists(spark, p.legacy_store) else None


def published_ids(spark: SparkSession, p: Paths) -> DataFrame | None:
    """Ids in the store and in a legacy store, each when it is there. The
    store's ids stand in its manifest: its documents aren't read."""
    legacy, ids = legacy_path(spark, p), []
    if path_exists(spark, p.store):
        settle_publish(spark, p)
        ids.append(manifest.read(spark, p.store_manifest).select("cve_id").distinct())
    if legacy:
        schema = StructType([StructField("cveId", StringType())])
        ids.append(S.read_json_store(spark, legacy, legacy=True, schema=schema).select(F.col("cveId").alias("cve_id")))
    return reduce(DataFrame.unionByName, ids) if ids else None


def new_run_id() -> str:
    return f"run-{uuid.uuid4().hex[:12]}"


def run_extract(spark: SparkSession, p: Paths, client_factory, full: bool = False,
                concurrency: int | None = None, sleep=time.sleep, run_id: str | None = None,
                patience_s: float | None = None, journal: Journal | NoJournal = NoJournal()) -> DataFrame:
    """Extract mode: source -> records to process (skip published ids unless
    ``full``) -> descriptions (first wins, insert-if-absent) -> model ladder
    -> staged docs for the successes. Writes the status reports and returns
    the run statistics. ``run_id`` of an interrupted run resumes it; without
    one a new run calls anew for ids that failed or were quarantined. Calls
    still put off by rate limits after ``patience_s`` seconds are left to the
    next run."""
    configure(spark)

    def prepare() -> None:
        src = S.read_csv_records(spark, p.src(), multiline=p.csv_multiline)
        store = published_ids(spark, p)
        # the prepared records are landed once: the reports and the model run read them
        ingest.records_to_process(src, None if full else store).write.mode("overwrite").parquet(f"{p.base}/to_process")
        todo = spark.read.parquet(f"{p.base}/to_process")
        none = spark.createDataFrame([], "cve_id string")
        status = ingest.processing_status(ingest.fill_and_drop_rejected(src), store if store is not None else none, todo)
        status.select(*[c for c in status.columns if c != "ord"]).write.mode("overwrite").parquet(f"{p.base}/status")
        status = spark.read.parquet(f"{p.base}/status")
        _report(status, p.report("processing_status"))
        _report(status.filter("processing_status = 'already_processed'").select("cve_id"), p.report("already_processed"))
        _report(todo.select("cve_id", "description"), p.report("to_process"))
        _report_row(ingest.processing_summary(status, store), p.report("processing_summary"))

    journal.step("extract.prepare", prepare)
    todo = spark.read.parquet(f"{p.base}/to_process")
    first = ingest.first_wins(todo.select("cve_id", "ord", "description"), "cve_id", "ord")

    def describe() -> None:
        new_desc = ingest.incremental_anti(first, _read(spark, p.descriptions))
        new_desc.select("cve_id", "description").write.mode("append").parquet(p.descriptions)

    journal.step("extract.descriptions", describe)

    def call() -> None:
        staged = read_staged(spark, p)
        # a record without an id can never be published (its file name fails
        # the CVE-<year>-<number> pattern), so it gets no model call
        pending = first.filter(F.col("cve_id").isNotNull()).select("cve_id", "description")
        if staged is not None:
            pending = pending.join(staged.select(I.key_from_suffix("file_name").alias("cve_id")), "cve_id", "left_anti")
        outcome = L.run_ladder(pending, p.attempts, client_factory, run_id or new_run_id(), concurrency, sleep=sleep, patience_s=patience_s)
        outcome.write.mode("overwrite").parquet(f"{p.base}/outcome")

    journal.step("extract.calls", call)
    out = spark.read.parquet(f"{p.base}/outcome")

    def stage() -> None:
        docs = out.filter(F.col("status") == "success").select(F.concat("cve_id", F.lit(I.STAGED_SUFFIX)).alias("file_name"), F.col("json").alias("content"))
        staged = read_staged(spark, p)
        if staged is not None:  # nothing, unless this step was cut off
            docs = docs.join(staged.select("file_name"), "file_name", "left_anti")
        docs.write.mode("append").parquet(p.staged)

    journal.step("extract.stage", stage)
    stats = N.run_stats(out)

    def report() -> None:
        _report(out.filter(F.col("status") == "failed").select("cve_id").orderBy("cve_id"), p.report("failed_ids"))
        _report(out.filter(F.col("status") == "deferred").select("cve_id").orderBy("cve_id"), p.report("deferred_ids"))
        _report_row(stats, p.report("run_stats"))

    journal.step("extract.reports", report)
    return stats


def run_reprocess(spark: SparkSession, p: Paths, client_factory, concurrency: int | None = None,
                  sleep=time.sleep, run_id: str | None = None) -> DataFrame:
    """Reprocess mode: staged docs with 0-1 fields get an enhancement call;
    improved answers replace them (new staged version)."""
    configure(spark)
    staged = read_staged(spark, p)
    if staged is None:
        raise ValueError("nothing is staged")
    ins = validate.insufficient_docs(staged).select("cve_id", "current_count", "content")
    desc = ingest.description_lookup(ins.select("cve_id"), spark.read.parquet(p.descriptions),
                                     S.read_csv_records(spark, p.src(), multiline=p.csv_multiline))
    res = L.reprocess(ins, desc.filter(F.col("description").isNotNull()), p.attempts, client_factory,
                      run_id or new_run_id(), concurrency, sleep=sleep)
    res.write.mode("overwrite").parquet(f"{p.base}/reprocess")
    res = spark.read.parquet(f"{p.base}/reprocess")
    cur = staged.select(I.key_from_suffix("file_name").alias("cve_id"), "content")
    up = N.upsert_if_better(cur, res)
    up.select(F.concat("cve_id", F.lit(I.STAGED_SUFFIX)).alias("file_name"), "content") \
        .write.mode("overwrite").parquet(f"{p.staged}_next")
    _swap(spark, p.staged)
    stats = N.reprocess_stats(res)
    _report_row(stats, p.report("reprocess_stats"))
    return stats


def _files(spark: SparkSession, target: str):
    """(filesystem, the table's path, its next version, its previous version)"""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    t = path(target)
    return t.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), t, path(f"{target}_next"), path(f"{target}_previous")


def _swap(spark: SparkSession, target: str) -> None:
    """Replace ``target`` by its fully written next version. ``_settle``
    finishes a swap that was cut short between the two renames."""
    fs, t, new, old = _files(spark, target)
    _settle(spark, target)
    if not fs.exists(new):  # this swap was made before
        return
    if fs.exists(t) and not fs.rename(t, old):
        raise OSError(f"cannot set {target} aside")
    if not fs.rename(new, t):
        raise OSError(f"cannot rename the next version of {target}")
    fs.delete(old, True)


def _settle(spark: SparkSession, target: str) -> None:
    """A previous version without a current one means that the next one was
    written whole and only its rename is due."""
    fs, t, new, old = _files(spark, target)
    if not fs.exists(old):
        return
    if not fs.exists(t) and not fs.rename(new, t):
        raise OSError(f"cannot rename the next version of {target}")
    fs.delete(old, True)


def read_staged(spark: SparkSession, p: Paths) -> DataFrame | None:
    _settle(spark, p.staged)
    return _read(spark, p.staged)


def run_validate(spark: SparkSession, p: Paths, do_validate: bool = True, check_missing: bool = True,
                 journal: Journal | NoJournal = NoJournal()) -> dict:
    """Validate mode: classify staged docs once (written), then quarantine
    split, reports and the missing-section scan of the published stores."""
    configure(spark)
    out = {}
    if do_validate and (isinstance(journal, Journal) and journal.done("validate.classify") or read_staged(spark, p) is not None):
        journal.step("validate.classify", lambda: validate.classify(read_staged(spark, p)).write.mode("overwrite").parquet(f"{p.base}/validation"))
        v = spark.read.parquet(f"{p.base}/validation")
        kept, bad = validate.quarantine_split(v)

        def split() -> None:
            bad.write.mode("overwrite").parquet(p.invalid)
            kept.select("file_name", "content").write.mode("overwrite").parquet(f"{p.staged}_next")

        journal.step("validate.split", split)
        journal.step("validate.swap", lambda: _swap(spark, p.staged))
        out["summary"] = validate.validation_summary(v)

        def report() -> None:
            _report(validate.invalid_report(v).select("cve_id", "size", "json_valid", "content_hash"),
                    p.report("invalid"))
            _report(validate.report_ids(v), p.report("empty_single_ids"))
            _report(v.select("cve_id", "size", "json_valid", "content_hash").orderBy("cve_id"), p.report("validation"))
            _report(validate.duplicate_groups(v.filter(F.col("content_hash").isNotNull()), "cve_id", hash_col="content_hash"),
                    p.report("duplicates"))
            _report_row(out["summary"], p.report("validation_summary"))
            _report_row(validate.issue_counts(v), p.report("issue_counts"))

        journal.step("validate.reports", report)
    docs = []
    if check_missing:
        store, legacy = read_store(spark, p), legacy_path(spark, p)
        if store is not None:
            docs.append(store.select(F.concat_ws("/", F.lit(""), "year", "bucket", F.concat("cve_id", F.lit(".json"))).alias("path"),
                                     F.col("value").alias("content")))
        if legacy:
            docs.append(S.scan_store_paths(spark, legacy))
    if docs:
        out["missing"] = validate.missing_section(reduce(DataFrame.unionByName, docs)).select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("cveId"))
    journal.step("validate.missing", lambda: _report(out["missing"], p.report("missing_keyphrases")) if docs else None)
    return out


class DocsFailed(RuntimeError):
    """Some documents could not be repaired; ``stats`` has the counts."""

    def __init__(self, stats):
        super().__init__(f"{stats['failed']} of {stats['processed']} documents could not be repaired")
        self.stats = stats


def run_repair(spark: SparkSession, p: Paths, copy_back: bool = False, fail_on_error: bool = False) -> DataFrame:
    """Repair mode: quarantined docs -> normalised text fields; optionally
    written over the staged docs. The statistics carry ``exit_code``: 1 when a
    document failed, else 0. ``fail_on_error`` raises ``DocsFailed`` then, when
    all that could be repaired is written."""
    configure(spark)
    bad = spark.read.parquet(p.invalid).select("file_name", "content")
    fixed = repair.repair_records(bad)
    fixed.write.mode("overwrite").parquet(p.fixed)
    fixed = spark.read.parquet(p.fixed)
    if copy_back:
        staged = read_staged(spark, p)
        if staged is None:
            raise ValueError("nothing is staged")
        repair.copy_back(staged, fixed).select("file_name", "content") \
            .write.mode("overwrite").parquet(f"{p.staged}_next")
        _swap(spark, p.staged)
    stats = repair.repair_stats(fixed)
    stats = stats.select("*", F.when(F.col("failed") > 0, 1).otherwise(0).alias("exit_code"))
    _report_row(stats, p.report("repair_stats"))
    _report(fixed.filter(F.col("status") == "failed").select("cve_id").orderBy("cve_id"), p.report("repair_failed"))
    if fail_on_error:
        row = stats.first()
        if row["exit_code"]:
            raise DocsFailed(row)
    return stats


def run_merge(spark: SparkSession, p: Paths, version: str = "1.0.0",
              impacts: DataFrame | None = None) -> DataFrame:
    """Merge mode: keyphrases, descriptions and technical impacts -> merged
    records and the impact-consistency report. Beside the staged tables the
    raw docs of the three stage folders are read, each when it is there; of
    an id on both sides the table's doc counts. Raises when nothing merges."""
    configure(spark)
    raw = {k: S.read_stage_docs(spark, f"{p.base}/{k}") for k in ("description", "keyphrases", "technical_impacts")}
    kp, staged = raw["keyphrases"].select("cve_id", "content"), read_staged(spark, p)
    if staged is not None:
        own = staged.select(I.key_from_split("file_name").alias("cve_id"), "content")
        kp = own.unionByName(kp.join(own.select("cve_id"), "cve_id", "left_anti"))
    descriptions, table = merge.parse_descriptions(raw["description"]), _read(spark, p.descriptions)
    if table is not None:
        table = table.select("cve_id", F.lit(True).alias("parsed"), F.lit(False).alias("doc_error"), "description")
        descriptions = table.unionByName(descriptions.join(table.select("cve_id"), "cve_id", "left_anti"))
    if impacts is None:
        impacts = merge.parse_impacts(raw["technical_impacts"])
    run_ts = spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")").first()[0]
    g = merge.merge_records(kp, descriptions, impacts, version=version, run_ts=run_ts)
    g.write.mode("overwrite").parquet(f"{p.base}/merge_groups")
    g = spark.read.parquet(f"{p.base}/merge_groups")
    m = merge.merged(g)
    stats = merge.merge_stats(g)
    if stats.first()["processed"] == 0:
        raise RuntimeError("nothing to merge")
    m.write.mode("overwrite").parquet(p.merged)
    _report(merge.impact_mismatch(m).select("cve_id", "direction", F.array_join("values", "|").alias("values")),
            p.report("impact_errors"))
    _report_row(stats, p.report("merge_stats"))
    return stats


def _file_names(df: DataFrame) -> DataFrame:
    return df.select(F.concat("cve_id", F.lit(".json")).alias("file_name"), "hash")


def _drop(spark: SparkSession, path: str) -> None:
    fs, t, _, _ = _files(spark, path)
    fs.delete(t, True)


def settle_publish(spark: SparkSession, p: Paths) -> None:
    """Make store and manifest agree: finish the replacement of a publish that
    was cut off, and enter what the store holds in the partitions it touched. A
    store without a manifest gets one."""
    if path_exists(spark, f"{p.publish_partitions}/_SUCCESS"):
        # whole new partitions were built but maybe not all put in place
        publish.write_store(spark.read.text(p.publish_partitions).select("year", "bucket", "value"), p.store, fmt="text")
        _drop(spark, p.publish_partitions)
    store = read_store(spark, p)
    note = path_exists(spark, f"{p.publish_note}/_SUCCESS")
    if store is not None and (note or not path_exists(spark, f"{p.store_manifest}/_SUCCESS")):
        if note and path_exists(spark, f"{p.store_manifest}/_SUCCESS"):
            store = manifest.read_partitions(store, spark.read.parquet(p.publish_note))
        manifest.append(manifest.of_documents(store, publish.record_hash), p.store_manifest, manifest.next_version(spark, p.store_manifest))
    _drop(spark, p.publish_note)


def run_publish(spark: SparkSession, p: Paths, on_conflict: str = "skip") -> DataFrame:
    """Publish mode: merged records into the year/bucket store. Records are
    compared by their canonical form without the run timestamp, with the
    hashes in the store's manifest: no document of the store is read but those
    of partitions that hold a replaced record. New records are appended to
    their partitions; ``overwrite`` rewrites the partitions of replaced ones; no
    other file is touched."""
    configure(spark)
    settle_publish(spark, p)
    full = merge.record_json(spark.read.parquet(p.merged))
    src = full.select(F.concat("cve_id", F.lit(".json")).alias("file_name"), publish.record_hash("json").alias("hash"))
    publish.with_layout(src).write.mode("overwrite").parquet(f"{p.base}/publish_source")
    src = spark.read.parquet(f"{p.base}/publish_source")
    known = manifest.current(manifest.read_partitions(manifest.read(spark, p.store_manifest), src))
    publish.hashed_actions(src, _file_names(known), on_conflict).write.mode("overwrite").parquet(f"{p.base}/publish_actions")
    acts = spark.read.parquet(f"{p.base}/publish_actions")
    stats = publish.publish_stats(acts)
    named = acts.filter(F.col("action").isin(publish.MOVED, publish.OVERWRITTEN)).select(
        F.regexp_replace("file_name", r"\.json$", "").alias("cve_id"), "hash", "year", I.folder("bucket").alias("bucket"), "action")
    if not named.isEmpty():
        named.write.mode("overwrite").parquet(p.publish_note)
        named = spark.read.parquet(p.publish_note)
        docs = full.join(named.select("cve_id", "year", "bucket"), "cve_id").select("year", "bucket", F.col("json").alias("value"))
        replaced = named.filter(F.col("action") == publish.OVERWRITTEN)
        if not replaced.isEmpty():
            touched = replaced.select("year", "bucket").distinct()
            old = manifest.read_partitions(read_store(spark, p), touched)
            keep = old.join(replaced.select("cve_id"), "cve_id", "left_anti").select("year", "bucket", "value")
            # built aside first: a partition is never read and replaced at once
            _drop(spark, p.publish_partitions)
            publish.write_store(keep.unionByName(docs.join(touched, ["year", "bucket"], "left_semi")), p.publish_partitions, mode="append", fmt="text")
            publish.write_store(spark.read.text(p.publish_partitions).select("year", "bucket", "value"), p.store, fmt="text")
            _drop(spark, p.publish_partitions)
            docs = docs.join(touched, ["year", "bucket"], "left_anti")
        publish.write_store(docs, p.store, mode="append", fmt="text")
        manifest.append(named, p.store_manifest, manifest.next_version(spark, p.store_manifest))
        _drop(spark, p.publish_note)
    _report_row(stats, p.report("publish_stats"))
    return stats


def run_pipeline(spark: SparkSession, p: Paths, client_factory=None, mode: str = "incremental",
                 sleep=time.sleep, run_id: str | None = None) -> dict:
    """``incremental`` / ``full``: extract -> validate -> merge -> publish;
    ``validate``: validation only; ``merge``: merge + publish only.

    Under a ``run_id`` every step is entered in ``journal/`` when its tables
    are committed: a run that was cut off anywhere and is started again under
    its id goes on from its last commit."""
    if mode not in ("incremental", "full", "validate", "merge"):
        raise ValueError(f"no such mode: {mode}")
    journal = Journal(spark, p.journal, run_id) if run_id else NoJournal()
    out = {}
    if mode in ("incremental", "full"):
        if client_factory is None:
            raise ValueError("extraction needs a model client")
        out["extract"] = run_extract(spark, p, client_factory, full=(mode == "full"), sleep=sleep, run_id=run_id, journal=journal)
    if mode in ("incremental", "full", "validate"):
        out["validate"] = run_validate(spark, p, journal=journal)
    if mode in ("incremental", "full", "merge"):
        journal.step("merge", lambda: run_merge(spark, p))
        out["merge"] = merge.merge_stats(spark.read.parquet(f"{p.base}/merge_groups"))
        journal.step("publish", lambda: run_publish(spark, p))
        out["publish"] = publish.publish_stats(spark.read.parquet(f"{p.base}/publish_actions"))
    return out
