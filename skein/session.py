"""Session settings and shared scratch locations."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. mapKeyDedupPolicy=LAST_WIN gives JSON
# objects with repeated keys the "last one wins" reading of a Python dict.
RUNTIME_CONF = {
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows and bytes a Python worker receives at once; bounds its memory
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``skein`` importable by Python workers (the model-call stage runs
    library code on executors): zip the package once per application and
    hand it to ``addPyFile``, the programmatic ``--py-files``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark)
    local_root = root[len("file:"):] if root.startswith("file:") else root
    if not local_root.startswith("/"):
        local_root = tempfile.mkdtemp(prefix="skein-pyfiles-")  # shipped by the driver
    target = os.path.join(local_root, f"pyfiles-{uuid.uuid4().hex[:8]}", "skein.zip")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators depend on (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


def get_spark(master: str | None = None, app: str = "skein",
              shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings used by the library."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if driver_memory:  # local mode: the driver JVM is the whole cluster
        b = b.config("spark.driver.memory", driver_memory)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # external model calls must not be duplicated by speculative tasks
         .config("spark.speculation", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a shared filesystem path);
    only a local session without it gets a private temp folder, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="skein-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own filesystem; other errors are raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def path_bytes(spark: SparkSession, path: str) -> int:
    """The size of a file, or of all files below a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


_MADE: list[str] = []  # scratch paths of this process that no scope has cleared


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder. It stays until
    the scope that it was made in ends (``scratch_scope``) or ``clear_scratch``
    is called: a lazy result may still read it."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table this process wrote; an absent one is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables made inside, when what was made from them is
    written elsewhere. Only paths that this process made are touched."""
    mark = len(_MADE)
    try:
        yield
    finally:
        done = _MADE[mark:]
        del _MADE[mark:]
        for path in done:
            delete_path(spark, path)


def release(spark: SparkSession) -> None:
    """Let go of what finished steps left: broadcasts and shuffle files stay
    until the driver collects its garbage, which a long run of steps outgrows."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def clear_scratch(spark: SparkSession) -> int:
    """Delete all scratch tables that this process made; their number."""
    done = list(_MADE)
    _MADE.clear()
    for path in done:
        delete_path(spark, path)
    return len(done)
