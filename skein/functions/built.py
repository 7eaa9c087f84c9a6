"""Column expressions that are built once.

A large expression costs the driver far more to put together in Python than to
plan: a call across the bridge for every operator in it. A Column is immutable,
so one built over named columns serves every frame that has them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column


def built_once(make: Callable[..., Column]) -> Callable[..., Column]:
    """Remember ``make``'s columns by its arguments, where all are plain names
    or flags; arguments that are columns themselves are built anew."""
    kept: dict = {}

    @wraps(make)
    def get(*args, **kw) -> Column:
        if not all(isinstance(a, (str, int)) for a in (*args, *kw.values())):
            return make(*args, **kw)
        key = (id(SparkContext._gateway), args, tuple(sorted(kw.items())))
        if key not in kept:
            kept[key] = make(*args, **kw)
        return kept[key]
    return get
