"""Session settings and the shared work folder.

The library never creates a global session; callers pass one in.  The
helpers here only build a session for tests, the bench and the examples,
and find the shared folder that materialized layers are written to.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan in the package relies on:
#   * UTC, so month strings derived from timestamps do not move with the host;
#   * ANSI on (the Spark 4 default), so bad casts and divisions fail loudly and
#     the operators guard every division explicitly;
#   * AQE on, with partition coalescing and skew-join splitting.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "chanfold", extra: dict | None = None) -> SparkSession:
    """Session for tests, examples and the bench (local mode)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_defaults(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Runtime SQL settings the plans depend on (time zone only).

    Applied to sessions we did not build (the driver's); other settings are
    left to the cluster owner.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Bytes of input files for which a shuffle starts with one more partition; a task
#: then sorts some hundred MB of rows at most, whatever the input.
INPUT_PER_PARTITION = 8 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SIZED: dict[str, str] = {}


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of partitions that shuffles start with grow with the input.

    Adaptive execution joins small ones again.  Inputs for which the session's
    own number is enough, and a number that the cluster owner set, are left
    alone."""
    app, own = spark.sparkContext.applicationId, spark.conf.get(_INITIAL, None)
    if own is not None and own != _SIZED.get(app):
        return
    wanted = -(-input_bytes // INPUT_PER_PARTITION)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        _SIZED[app] = str(wanted)
        spark.conf.set(_INITIAL, _SIZED[app])
    elif own is not None:
        spark.conf.unset(_INITIAL)


@contextmanager
def open_folders(spark: SparkSession, n: int):
    """Within it, a task that writes up to ``n`` partition folders keeps a file
    of each open instead of sorting its rows by folder first; with more folders
    it sorts the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(n, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialized layers.

    Uses ``spark.checkpoint.dir`` when the cluster names one (it must be a
    folder every executor can reach).  When nothing is configured, a private
    temporary folder is created and registered as the checkpoint folder, but
    only if the driver is the only process (master ``local...``); elsewhere
    that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            configured = current
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="chanfold-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (a path
    without a scheme belongs to the default file system)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``chanfold`` importable in Python workers (needed by the few
    ``mapInPandas`` tasks): the package is zipped once per application into
    the shared work folder and handed to ``addPyFile``, which distributes it
    to every executor."""
    import hashlib
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import chanfold
    root = os.path.dirname(os.path.abspath(chanfold.__file__))
    parent = os.path.dirname(root)
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".py"))
    digest = hashlib.sha256()
    for full in files:
        digest.update(full.encode())
        with open(full, "rb") as fh:
            digest.update(fh.read())
    name = f"chanfold-{digest.hexdigest()[:16]}.zip"
    # Zipped on the driver, then copied into the shared folder.
    local_zip = os.path.join(tempfile.mkdtemp(prefix="chanfold-pkg-"), name)
    with zipfile.ZipFile(local_zip, "w", zipfile.ZIP_DEFLATED) as z:
        for full in files:
            z.write(full, os.path.relpath(full, parent))
    jvm = spark.sparkContext._jvm
    shared = jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/chanfold-pkg/{name}")
    fs = shared.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(shared):
        fs.copyFromLocalFile(True, True, jvm.org.apache.hadoop.fs.Path(f"file://{local_zip}"), shared)
    target = fs.makeQualified(shared).toString()
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
