"""Partition-layout helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


SCAN_PARTITIONS = "skein.scan.partitions"


def balance(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread CPU-heavy row work (regex cleaning, JSON parsing, model calls)
    over ``partitions`` tasks when the caller knows that the reader can't be
    split (a gzip file, one row group). The number is an argument or the
    session setting ``skein.scan.partitions``; unset, the scan's own splits
    stay and nothing is shuffled."""
    n = partitions or int(df.sparkSession.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(n) if n else df


def fence(df: DataFrame) -> DataFrame:
    """Compute the projection below once per row and keep later filters above it.

    ``inline(array(struct(*cols)))`` is a one-row-per-row Generate. Catalyst
    neither pushes a filter on generator output below it nor inlines the
    expressions that feed it, so an expensive column (a JSON parse, a
    regex chain) that later filters and projections read several times is
    evaluated exactly once.
    """
    from pyspark.sql import functions as F
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
