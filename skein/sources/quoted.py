"""Delimited files with quoted newlines, read by many tasks.

A newline ends a record only outside quotes, and whether a byte range begins
inside quotes depends on everything before it. So the ranges are read twice.

1. Each range is scanned for both cases, beginning outside and beginning inside
   a quoted field, and says in which state it ends in either case. It also
   keeps its edges: the lines before its first record start and those after its
   last one. One small row a range goes to the driver, which plans the ranges
   anyway; running through a file's ranges in order gives each range's true state.
2. Each range gives out the records that lie whole inside it. Records across
   ranges are put together from the edges, a few lines a range.

A line without a quote ends in the state it began in. Otherwise fields are
followed as the parser reads them: a quote opens a field only at its beginning,
a doubled (``standard``) or backslashed (``legacy``) quote is text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import scratch_path

# a quote that closes, or a pair of characters that doesn't
_IN_QUOTES = {"standard": re.compile('""|"'), "legacy": re.compile(r'\\.|"', re.S)}

EDGES = ("file string, start long, end0 boolean, end1 boolean, starts1 boolean, n0 long, n1 long, "
         "head string, tail0 string, tail1 string")


def ends_inside(line: str, inside: bool, profile: str = "standard") -> bool:
    """Whether a line that begins inside (or outside) quotes ends inside."""
    if '"' not in line:
        return inside
    token, at = _IN_QUOTES[profile], 0
    while True:
        if not inside:  # at a field's first character
            if line.startswith('"', at):
                at += 1
            else:
                at = line.find(',"', at) + 2
                if at == 1:
                    return False
        m = token.search(line, at)
        while m and m.group() != '"':
            m = token.search(line, m.end())
        if m is None:
            return True
        at = line.find(",", m.end()) + 1
        if not at:
            return False
        inside = False


class _Case:
    """One reading of a range: its records so far, and the open one's lines."""

    def __init__(self, inside: bool):
        self.inside, self.count = inside, 0
        self.head: list[str] = []  # lines before the first record start
        self.open: list[str] = []  # lines of the last record

    def add(self, line: str, profile: str) -> str | None:
        """Takes a line; gives the record that it shows to be complete."""
        done = None
        if not self.inside:
            done, self.open = ("\n".join(self.open) if self.count else None), [line]
            self.count += 1
        elif self.count:
            self.open.append(line)
        else:
            self.head.append(line)
        self.inside = ends_inside(line, self.inside, profile)
        return done


def _lines(spark: SparkSession, path: str) -> DataFrame:
    # a carriage return stays with its line: it is text inside quotes
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """Runs of lines of one range; a range may come in several runs."""
    for b in batches:
        lines, files, starts = (c.to_pylist() for c in b.columns)
        at = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or starts[i] != starts[at] or files[i] != files[at]:
                yield files[at], starts[at], lines[at:i]
                at = i


def _find_edges(profile: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, zero, one = None, _Case(False), _Case(True)

        def row() -> pa.RecordBatch:
            cols = [*key, zero.inside, one.inside, one.count > 0, zero.count, one.count, "\n".join(one.head), "\n".join(zero.open), "\n".join(one.open)]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(cols, kinds)], [c.split()[0] for c in EDGES.split(", ")])

        for file, start, lines in _ranges(batches):
            if key != (file, start):
                if key:
                    yield row()
                key, zero, one = (file, start), _Case(False), _Case(True)
            for line in lines:
                zero.add(line, profile)
                one.add(line, profile)
        if key:
            yield row()
    return run


def _whole_records(profile: str, inside: dict[tuple[str, int], bool]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, case = None, None
        for file, start, lines in _ranges(batches):
            if key != (file, start):
                if (file, start) not in inside:
                    raise ValueError(f"{file} was split anew since it was planned; read it again")
                key, case = (file, start), _Case(inside[file, start])
            out, rows = [], []
            for line in lines:
                record = case.add(line, profile)
                if record is not None:
                    out.append(record)
                    rows.append(start + case.count - 2)
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(out), pa.string()), pa.array(rows, pa.int64()), pa.array(out, pa.string())],
                                             ["file", "row", "record"])
    return run


def quoted_records(spark: SparkSession, path: str, profile: str = "standard") -> DataFrame:
    """(file, row, record): the text of every record of the files under
    ``path``, headers included. ``row`` grows with the place in the file; the
    first record of a file has row 0. An empty file has no records."""
    edges_path = scratch_path(spark, "csv-edges")
    lines = _lines(spark, path)
    lines.mapInArrow(_find_edges(profile), EDGES).write.parquet(edges_path)
    edges = spark.read.schema(EDGES).parquet(edges_path)
    inside, owner = {}, {}
    before: tuple | None = None
    for r in sorted(edges.drop("head", "tail0", "tail1").collect(), key=lambda r: (r["file"], r["start"])):
        if before is None or before[0] != r["file"]:
            before = (r["file"], False, None)  # file, state, range of the record still open
        at = (r["file"], r["start"])
        inside[at], owner[at] = before[1], before[2]
        begins = r["starts1"] if before[1] else r["n0"] > 0
        before = (r["file"], r["end1"] if before[1] else r["end0"], r["start"] if begins else before[2])
    whole = lines.mapInArrow(_whole_records(profile, inside), "file string, row long, record string")
    # the last record of every range, with the heads of the ranges after it
    known = spark.createDataFrame([(f, s, inside[f, s], owner[f, s]) for f, s in sorted(inside)], "file string, start long, began boolean, owner long")
    e = edges.join(known, ["file", "start"])
    count = F.when(F.col("began"), F.col("n1")).otherwise(F.col("n0"))
    tails = e.filter(count > 0).select("file", F.col("start").alias("owner"), F.lit(-1).cast("long").alias("place"), (F.col("start") + count - 1).alias("row"),
                                       F.when(F.col("began"), F.col("tail1")).otherwise(F.col("tail0")).alias("part"))
    heads = e.filter(F.col("began")).select("file", "owner", F.col("start").alias("place"), F.lit(None).cast("long").alias("row"), F.col("head").alias("part"))
    parts = F.array_sort(F.collect_list(F.struct("place", "part")))
    across = tails.unionByName(heads).groupBy("file", "owner").agg(
        F.max("row").alias("row"), F.array_join(F.transform(parts, lambda p: p["part"]), "\n").alias("record"))
    return whole.unionByName(across.select("file", "row", "record"))


def read_quoted(spark: SparkSession, path: str, columns: list[str], options: dict[str, str], profile: str = "standard") -> DataFrame:
    """The files' rows with the given columns as strings, and ``file`` and
    ``row``; each file's header is left out, and so are empty lines."""
    recs = quoted_records(spark, path, profile).filter((F.col("row") > 0) & ~F.col("record").isin("", "\r"))
    names = [f"c{i}" for i in range(len(columns))]
    text = F.regexp_replace("record", r"\r\z", "")
    parsed = recs.select("file", "row", F.from_csv(text, ", ".join(f"{n} string" for n in names), options).alias("r"))
    return parsed.select(*[F.col(f"r.{n}").alias(c) for n, c in zip(names, columns)], "file", "row")
