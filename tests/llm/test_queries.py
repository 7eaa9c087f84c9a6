import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skein.llm import decontam, langid, neardup, secrets, spbpe
from skein.llm.queries import INJECTION, ORACLE, QUERIES, model_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
    from oracle_check import duck_conn
    return duck_conn(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    from oracle_check import rows_of
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    assert len(set(df.columns)) == len(df.columns) and sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    df = QUERIES[name](spark, SF)
    if "doc_id" in df.columns:
        ids = sorted(r.doc_id for r in df.select("doc_id").collect())
        assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    else:
        assert df.count() > 0


def test_injected_conversation(spark):
    import hashlib
    r = QUERIES["op8_chat_formatting"](spark, SF).where("conv_id = -1").first()
    lines = f"user\n{INJECTION}\nassistant\n{INJECTION}\n"
    assert (r.n_turns, r.turns_sha256) == (2, hashlib.sha256(lines.encode()).hexdigest())
    assert (r.loss_chars, r.loss_sha256) == (len(INJECTION), hashlib.sha256(INJECTION.encode()).hexdigest())


# -------------------------------------------------------------- pipeline

EXTRA = [(10**6, None, "en", "s", 0), (10**6 + 1, "", "en", None, 0), (10**6 + 2, "1 2 3 4 5 6", None, "s", None), (None, "the of and a with no id", "en", "s", 3),
         (10**6 + 3, "the and of with password=abcdefghijklmnop in it", "en", "s", 5), (10**6 + 3, "the and of with password=abcdefghijklmnop in it", "en", "s", 5)]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    more = spark.createDataFrame(EXTRA, d.schema)
    from pyspark.sql import functions as F
    return d.unionByName(more).withColumn("keep_id", F.lit(1)).withColumn("bad_id", F.lit(1)).withColumn("score", F.lit("x"))


def rows(df):
    return sorted(df.collect(), key=str)


def test_language_stage(spark, docs):
    got = corpus_pipeline.language_id(spark, docs, SF)
    assert tuple(got.columns) == corpus_pipeline.COLUMNS
    want = langid.detect(docs, langid.train(docs)).where("lang_pred <> 'und'")
    assert rows(got.select("doc_id")) == rows(want.select("doc_id"))
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in got.collect()}
    assert {10**6, 10**6 + 1, 10**6 + 2} <= gone and 10**6 + 3 not in gone


def test_language_stage_keeps_unsure_texts(spark, docs, monkeypatch):
    unsure = langid.Network(["de", "en", "es", "fr"])
    unsure.p["out"][:], unsure.p["bias"][:] = 0, 0  # 0.25 each
    monkeypatch.setattr(langid, "train", lambda docs: unsure)
    assert langid.detect(docs, unsure).where("score > 0.3").isEmpty()
    got = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    assert got == {r.doc_id for r in docs.collect()} - {10**6, 10**6 + 1, 10**6 + 2}


def test_dedup_stage(spark, docs):
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert tuple(got.columns) == corpus_pipeline.COLUMNS
    ids = [r.doc_id for r in got.collect() if r.doc_id is not None]
    want = {r.doc_id for r in neardup.near_duplicates(docs).where("kept").collect()} - {None}
    assert len(ids) == len(set(ids)) and set(ids) == want


def test_dedup_stage_removes_near_copies_of_any_id(spark):
    import random
    rng = random.Random(5)

    def near(n):  # texts of one group
        words = [f"w{rng.randrange(3000)}" for _ in range(200)]
        return [" ".join([*words, f"end{k}"]) for k in range(n)]
    one, two, three, four = near(3), near(2), near(2), near(2)
    rows = [(1, one[0]), (1, one[1]), (1, "another text of this id, unlike the others"), (2, one[2]),  # near copies share an id
            (3, two[0]), (None, two[1]),            # a near copy without an id
            (None, three[0]), (None, three[1]), (None, three[1]),  # a group without ids
            (4, four[0]), (4, four[0]), (5, four[1]),
            (None, ""), (None, ""), (None, None), (6, None), (6, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()), key=str)
    free = [(1, rows[2][1]), (3, two[0]), (4, four[0]), (None, ""), (None, None), (6, None), (6, "")]
    assert [r for r in got if r in free] == sorted(free, key=str)
    rest = [r for r in got if r not in free]
    assert len(rest) == 2 and sum(r in [(1, one[0]), (1, one[1])] for r in rest) == 1 and sum(r in [(None, t) for t in three] for r in rest) == 1


def test_dedup_stage_works_out_the_groups_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def search(docs, text_key):
        def tell(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        got = docs.select("doc_id", text_key.alias("text_key"), F.lit(True).alias("kept"), F.when(F.col("doc_id") > 1, F.col("doc_id")).alias("group_key"))
        return got.mapInArrow(tell, got.schema)
    monkeypatch.setattr(neardup, "near_duplicates", search)
    data = [(1, "", "en", "s", 0), (2, "a text", "en", "s", 6), (3, "another", "en", "s", 7)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows(corpus_pipeline.near_dedup(spark, docs, SF)) == rows(docs) and seen.value == 3


def test_leak_stage(spark, docs):
    got = corpus_pipeline.decontaminate(spark, docs, SF)
    # each row is judged by its own text: found through numbers of the rows
    numbered = docs.select(*corpus_pipeline.COLUMNS).collect()
    by_row = spark.createDataFrame([(k, r.text) for k, r in enumerate(numbered)], "doc_id long, text string")
    bad = {r.doc_id for r in decontam.find_items(by_row, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert bad and rows(got) == sorted((r for k, r in enumerate(numbered) if k not in bad), key=str)


def test_leak_stage_judges_rows_without_an_id_one_by_one(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    data = [(None, f"before {item} after", "en", "s", 1), (None, "clean text without an id", "en", "s", 1), (7, item, "en", "s", 1), (7, "clean text of id seven", "de", "s", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows(corpus_pipeline.decontaminate(spark, docs, SF)) == sorted([spark.createDataFrame([d], docs.schema).first() for d in (data[1], data[3])], key=str)


def test_dedup_stage_keeps_the_smallest_of_rows_that_repeat(spark):
    data = [(1, "one and the same text", "es", "b", 3), (1, "one and the same text", "en", "z", 9), (1, "one and the same text", "en", "a", None), (2, "quite another one", None, None, None),
            (2, "quite another one", None, None, None), (None, "of no id", "en", "s", 1), (None, "of no id", "de", "s", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = sorted((tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, "one and the same text", "en", "a", None), (2, "quite another one", None, None, None), (None, "of no id", "de", "s", 1)], key=str)


def test_secret_stage(spark, docs):
    got = corpus_pipeline.redact_secrets(spark, docs, SF)
    before = rows(docs.select(*corpus_pipeline.COLUMNS))
    assert got.count() == len(before) and tuple(got.columns) == corpus_pipeline.COLUMNS
    assert not any(s.kind in ("access", "assign") for r in secrets.scan_secrets(got).collect() for s in r.found)


def test_token_stage(spark, docs):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for r in corpus_pipeline.tokenize(spark, docs, SF).join(docs.select("doc_id", "text"), "doc_id").limit(50).collect():
        ids = lib.encode(r.text or "", add_bos=True, add_eos=True)
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids) and r.decoded == lib.decode(ids)


def test_stages_on_an_empty_table(spark, docs):
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_run_applies_the_stages_in_order(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = spark.createDataFrame(stage(spark, d, SF).collect(), d.select(*corpus_pipeline.COLUMNS).schema)
    want = {r.doc_id: spbpe.load_model(spbpe.read_model(model_path())).encode(r.text).tobytes() for r in d.collect()}
    assert {r.doc_id: bytes(r.ids) for r in corpus_pipeline.run(spark, SF).collect()} == want
