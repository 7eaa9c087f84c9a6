"""Record preparation: rejected fill/filter, incremental anti-join,
cleaning, placeholder filter, first-wins and processing status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators.layout import balance, fence
from skein.session import scratch_path

ID, DESC, STATE, REASON = "cve_id", "description", "state", "rejected_reason"


def fill_and_drop_rejected(src: DataFrame) -> DataFrame:
    """Rejected + blank description -> rejection reason; then drop rejected
    rows that are still blank. Applies only when both optional columns exist."""
    if STATE not in src.columns or REASON not in src.columns:
        return src
    filled = src.withColumn(DESC, T.rejected_fill(DESC, STATE, REASON))
    return filled.filter(T.keep_not_rejected_blank(DESC, STATE))


def incremental_anti(src: DataFrame, done: DataFrame | None, key: str = ID,
                     done_key: str | None = None) -> DataFrame:
    """Rows of ``src`` whose key is not in ``done``; null keys match null keys.

    ``<=>`` stays an equi-join key (Catalyst rewrites it to
    ``(coalesce(k, ''), isnull(k))``), so the plan is a hash or sort-merge
    anti-join, never a nested loop. Only the key column of ``done`` is read;
    Catalyst broadcasts it on its own when its measured size is under the
    threshold and shuffles otherwise. An empty or missing store keeps all.
    """
    if done is None:
        return src
    done_key = done_key or key
    d = done.select(F.col(done_key).alias("__done_key"))
    return src.join(d, src[key].eqNullSafe(d["__done_key"]), "left_anti")


FILTER_BITS = 1 << 27  # of a key filter: 16 MB, the most that is broadcast
_WORD = 1 << 15        # bits in one bitmap row


def _place(key, bits: int):
    """A key's bit; a null key has its own."""
    return F.pmod(F.xxhash64(key.cast("string"), key.isNull()), F.lit(bits))


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter of a column as a table ``(word, map)`` of 4 kB bitmaps,
    built by a partial aggregation: every task hands on one map a word. It has
    at most ``bits`` / 32768 rows, whatever the number of keys."""
    p = keys.select(_place(F.col(key), bits).alias("place"))
    return p.groupBy(F.floor(F.col("place") / _WORD).alias("word")).agg(F.bitmap_construct_agg(F.col("place") % _WORD).alias("map"))


def with_maybe(df: DataFrame, key: str, words: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with ``__maybe``: false where the filter proves that the key isn't
    in it. The filter is broadcast, at most ``bits`` / 8 bytes."""
    place = _place(F.col(key), bits)
    w = words.select(F.col("word").alias("__word"), F.col("map").alias("__map"))
    j = df.join(F.broadcast(w), F.floor(place / _WORD) == w["__word"], "left")
    at = (place % _WORD).cast("int")
    byte = F.conv(F.hex(F.substring("__map", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), at % 8)) % 2
    return j.select(*[df[c] for c in df.columns], F.coalesce(bit == 1, F.lit(False)).alias("__maybe"))


def incremental_anti_large(src: DataFrame, done: DataFrame | None, key: str = ID, done_key: str | None = None,
                           bits: int = FILTER_BITS) -> DataFrame:
    """``incremental_anti`` for a store above the broadcast threshold.

    A filter of the source's keys goes to the store's tasks, and only the keys
    it lets through are written out: the store is scanned, not shuffled. A
    filter of those goes to the source's tasks: rows it rules out are surely new
    and pass in place; only the others meet the written keys. Both filters err
    on one side only, so the result is the same at any fill; the fuller they
    are, the more rows are shuffled. The source is read three times: land it
    first where reading it is dear."""
    if done is None:
        return src
    spark = src.sparkSession
    d = done.select(F.col(done_key or key).alias("__done_key"))
    hits = with_maybe(d, "__done_key", key_filter(src, key, bits), bits).filter("__maybe").select("__done_key")
    path = scratch_path(spark, "done-keys")
    hits.write.parquet(path)
    hits = spark.read.schema("__done_key " + d.schema[0].dataType.simpleString()).parquet(path)
    flagged = with_maybe(src, key, key_filter(hits, "__done_key", bits), bits)
    new = flagged.filter(~F.col("__maybe")).drop("__maybe")
    rest = flagged.filter("__maybe").drop("__maybe")
    return new.unionByName(rest.join(hits, rest[key].eqNullSafe(hits["__done_key"]), "left_anti"))


def clean_and_filter(df: DataFrame) -> DataFrame:
    """Clean descriptions (markup, punctuation, non-ASCII, spaces, kernel
    traces) and drop blank or placeholder ones.

    Written as ``explode(filter(transform(array(clean(d)), kernel), keep))``:
    the five-regex cleaning runs once per row and the kernel rule and the
    placeholder test read the cleaned text through a lambda variable. A
    plain ``withColumn`` + ``filter`` lets Catalyst push the filter below
    the anti-join and inline the aliases, so every source row (not only the
    new ones) would be cleaned, and many times over.
    """
    cleaned = F.transform(F.array(T.clean_description(DESC)), T.trim_kernel_trace)
    kept = F.filter(cleaned, T.keep_valid_text)
    others = [c for c in df.columns if c != DESC]
    return df.select(*others, F.explode(kept).alias(DESC))


def records_to_process(src: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """The minimum slice: fill/drop rejected -> anti-join done work -> clean
    -> filter. Narrow transformations plus one anti-join."""
    return clean_and_filter(balance(incremental_anti(fill_and_drop_rejected(src), done)))


def first_wins(df: DataFrame, key: str = ID, order: str = "ord") -> DataFrame:
    """Keep the first row per key in source order.

    ``min(struct(order, ...))`` has a map-side partial step, so a key holding
    a large share of the rows is reduced to one row per task before the
    shuffle (a window would sort the whole hot group in one task). The buffer
    holds texts, which makes it a sort aggregate.
    """
    others = [c for c in df.columns if c != key]
    packed = F.min(F.struct(F.col(order), *[F.col(c) for c in others if c != order]))
    return (df.groupBy(key).agg(packed.alias("__first"))
            .select(key, *[F.col("__first")[c].alias(c) for c in others]))


def insert_if_absent(new: DataFrame, target: DataFrame | None, key: str = ID,
                     order: str = "ord") -> DataFrame:
    """Rows to append so that each key is written once: first row per key
    among ``new``, minus keys already in ``target``."""
    first = first_wins(new, key, order) if order in new.columns else new.dropDuplicates([key])
    return incremental_anti(first, target, key)


def processing_status(all_rows: DataFrame, already: DataFrame, to_process: DataFrame,
                      key: str = ID) -> DataFrame:
    """Status per source row: already_processed / to_be_processed /
    filtered_out, in that precedence. Two left joins on distinct keys; texts
    are cut and measured before them."""
    a = already.select(F.col(key).alias("__a")).distinct().withColumn("__in_a", F.lit(True))
    p = to_process.select(F.col(key).alias("__p")).distinct().withColumn("__in_p", F.lit(True))
    extra = [c for c in (STATE, REASON, "ord") if c in all_rows.columns]
    # a generated row: the joins can't pull the whole text above them again
    short = fence(all_rows.select(F.col(key).alias(ID), T.truncate_200(all_rows[DESC]).alias(DESC),
                                  T.text_length(all_rows[DESC]).alias("description_length"), *extra))
    j = short.join(a, short[ID] == a["__a"], "left").join(p, short[ID] == p["__p"], "left")
    status = (F.when(F.col("__in_a"), F.lit("already_processed"))
              .when(F.col("__in_p"), F.lit("to_be_processed"))
              .otherwise(F.lit("filtered_out")))
    return j.select(ID, DESC, "description_length", status.alias("processing_status"), *extra)


def processing_summary(status: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """One row of counts over the status table. When the store is given,
    ``filtered_out_by_subtraction`` reproduces the report figure
    total - store size - to_process (the store counts every published
    record, so it can go negative); the flag counts are exact. Both inputs
    are scanned in one aggregate over a tagged union (no join)."""
    rows = status.select(F.col("processing_status"), F.lit(False).alias("__store"))
    if store is not None:
        rows = rows.unionByName(store.select(F.lit(None).cast("string").alias("processing_status"),
                                             F.lit(True).alias("__store")))
    st = F.col("processing_status")
    agg = rows.agg(
        F.count_if(~F.col("__store")).alias("total"),
        F.count_if(st == "already_processed").alias("already_processed"),
        F.count_if(st == "to_be_processed").alias("to_be_processed"),
        F.count_if(st == "filtered_out").alias("filtered_out"),
        F.count_if(F.col("__store")).alias("store_total"))
    if store is not None:
        agg = agg.withColumn("filtered_out_by_subtraction",
                             F.col("total") - F.col("store_total") - F.col("to_be_processed"))
    else:
        agg = agg.drop("store_total")
    return agg.select([F.col(c).cast("bigint") for c in agg.columns])


def description_lookup(ids: DataFrame, desc_docs: DataFrame, source: DataFrame,
                       key: str = ID) -> DataFrame:
    """Description per id: the staged description doc, else the cleaned
    (markup/punctuation/ASCII/space steps only) first source row. Source rows
    of ids that aren't asked for leave before anything is made of their text."""
    d = desc_docs.select(F.col(key).alias("__k1"), F.col(DESC).alias("__doc"))
    asked = source.select(key, DESC, "ord").join(ids.select(key), key, "left_semi")
    s = (first_wins(asked, key, "ord")
         .select(F.col(key).alias("__k2"), T.clean_description(DESC).alias("__src")))
    j = ids.join(d, ids[key] == d["__k1"], "left").join(s, ids[key] == s["__k2"], "left")
    return j.select(ids[key].alias(ID), F.coalesce("__doc", "__src").alias(DESC),
                    F.when(F.col("__doc").isNotNull(), F.lit("description_doc"))
                    .when(F.col("__src").isNotNull(), F.lit("source"))
                    .alias("found_in"))
