"""Which steps of a run are done.

A step is entered after its table is committed, as an empty file named after
it in the run's folder: one atomic create in the shared filesystem, no job. A
run taken up again under its id skips the steps that are entered and goes on
with the first one that isn't; that step's table is written anew.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import SparkSession


class Journal:
    def __init__(self, spark: SparkSession, folder: str, run_id: str):
        if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
            raise ValueError(f"{run_id!r} can't name a folder")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.folder = f"{folder}/{run_id}"
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def done(self, step: str) -> bool:
        return self._fs.exists(self._path(f"{self.folder}/{step}"))

    def enter(self, step: str) -> None:
        self._fs.create(self._path(f"{self.folder}/{step}"), True).close()

    def step(self, name: str, make: Callable[[], object]) -> None:
        """Run ``make`` unless the journal says that it was done."""
        if not self.done(name):
            make()
            self.enter(name)


class NoJournal:
    """For a stage that is run by itself: every step is made."""

    def step(self, name: str, make: Callable[[], object]) -> None:
        make()
