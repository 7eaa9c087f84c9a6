"""URL filters: a sort-merge range join of urls with block/allow rules.

A host is keyed by its labels in reverse, each followed by a dot
(``blog.example.net`` -> ``net.example.blog.``). A rule on a host then covers
the interval of all keys starting with the rule's key: the host itself and its
subdomains. Intervals of two rules are nested or disjoint, so one pass over
urls and rules sorted by key needs only a stack of the rules now open.

Distribution: split points drawn from a bounded sample of the keys cut the key
space into buckets. A rule goes to each bucket that its interval meets; a url
to its own. A key frequent enough to be several split points in a row is dealt
over all the buckets between them, so a hot host is spread over many tasks.
The sample decides only where rows are processed, never the result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, shuffle_partitions

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

RULE_SCHEMA = "host string, path string, action string"
SAMPLE_PER_BUCKET = 16  # sampled keys per bucket, for the split points only


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _sweep(default: str, id_names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, dict]] = []  # open rules: (key, path -> (action, rule))
        bucket, at, options = None, None, None
        for batch in batches:
            c = batch.select(["bucket", "host_key", "kind", "path", "action", "rule"]).to_pydict()
            found = []
            for b, key, kind, path, action, rule in zip(*c.values()):
                if b != bucket:
                    bucket, at = b, None
                    stack.clear()
                if key != at:
                    while stack and not key.startswith(stack[-1][0]):
                        stack.pop()
                    at, options = key, None
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}))
                    paths = stack[-1][1]
                    # one host and path given twice: the smaller action stays
                    paths[path] = min(paths.get(path, (action, rule)), (action, rule))
                    options = None
                    continue
                if options is None:  # path lengths of each open host, deepest host first
                    options = [(p, sorted({len(x) for x in p}, reverse=True), len(k)) for k, p in reversed(stack)]
                best = None
                for paths, lengths, host_len in options:
                    for n in lengths:
                        hit = paths.get(path[:n]) if n <= len(path) else None
                        if hit is not None:
                            if best is None or host_len + n > best[0]:
                                best = (host_len + n, hit)
                            break
                found.append(best[1] if best else (default, None))
            urls = batch.filter(pa.array([k == 1 for k in c["kind"]], pa.bool_())).select([*id_names, "host", "path"])
            yield pa.RecordBatch.from_arrays(
                [*urls.columns, pa.array([x[1] for x in found], pa.string()), pa.array([x[0] for x in found], pa.string())],
                [*id_names, "host", "path", "rule", "verdict"])
    return run


def apply_rules(urls: DataFrame, rules: DataFrame, id_cols: Sequence[str] = ("page_id",), url_col: str = "url",
                default: str = "allow", buckets: int | None = None) -> DataFrame:
    """Judge each url by the longest rule that fits it.

    ``rules`` has (host, path, action); a rule fits its host and all
    subdomains when the url's path starts with the rule's. Longest is by
    characters of host and path; at equal length the deeper host wins, at an
    equal rule the smaller action. Returns ``id_cols`` + host, path, rule, verdict.

    A null url or one without ``://`` has empty host and path and meets only a
    rule with an empty host. No rule: rule null, verdict ``default``. Repeated
    rows are judged each; null ids stay; rules with a null host, path or action
    are ignored; either table may be empty. Only ``id_cols`` and the url are
    read, so other columns may have any name.
    """
    spark = prepare(urls.sparkSession)
    n = buckets or 4 * shuffle_partitions(spark)
    ids = [F.col(f"`{c}`").alias(f"id_{i}") for i, c in enumerate(id_cols)]
    names = [f"id_{i}" for i in range(len(ids))]
    u = (urls.select(*ids, F.col(f"`{url_col}`").alias("url"))
         .select(*names, url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                 F.xxhash64(*names, "url").alias("salt"))
         .withColumn("host_key", host_key(F.col("host"))))
    total = urls.count()
    fraction = min(1.0, SAMPLE_PER_BUCKET * n / total) if total else 1.0
    keys = sorted(r[0] for r in u.select("host_key").sample(fraction=fraction, seed=7).collect())
    cuts = [keys[i * len(keys) // n] for i in range(1, n)] if keys else []

    @F.pandas_udf("int")
    def url_bucket(key: pd.Series, salt: pd.Series) -> pd.Series:
        span = {k: (bisect.bisect_left(cuts, k), bisect.bisect_right(cuts, k)) for k in key.unique()}
        return pd.Series([(lo := span[k][0]) + zlib.crc32(str(s).encode()) % (span[k][1] - lo + 1)
                          for k, s in zip(key, salt)], dtype="int32")

    @F.pandas_udf("array<int>")
    def rule_buckets(key: pd.Series) -> pd.Series:
        # '/' follows '.', the last character of a key: it closes the interval
        return pd.Series([list(range(bisect.bisect_left(cuts, k), bisect.bisect_left(cuts, k[:-1] + "/") + 1))
                          for k in key], dtype=object)

    r = (rules.select("host", "path", "action").dropna()
         .withColumn("host", F.translate("host", _UPPER, _LOWER))
         .withColumn("host_key", host_key(F.col("host")))
         .withColumn("bucket", F.explode(rule_buckets("host_key"))))
    types = {f.name: f.dataType for f in u.schema}
    blank = [F.lit(None).cast(types[c]).alias(c) for c in names]
    events = (u.withColumn("bucket", url_bucket("host_key", "salt"))
              .select("bucket", "host_key", F.lit(1).alias("kind"), *names, "host", "path",
                      F.lit(None).cast("string").alias("action"), F.lit(None).cast("string").alias("rule"))
              .unionByName(r.select("bucket", "host_key", F.lit(0).alias("kind"), *blank, "host", "path", "action",
                                    F.concat("host", "path").alias("rule"))))
    out = T.StructType([T.StructField(c, types[c]) for c in names]
                       + [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")])
    swept = (events.repartition(n, "bucket").sortWithinPartitions("bucket", "host_key", "kind")
             .mapInArrow(_sweep(default, names), out))
    return swept.select(*[F.col(f"id_{i}").alias(c) for i, c in enumerate(id_cols)], "host", "path", "rule", "verdict")
