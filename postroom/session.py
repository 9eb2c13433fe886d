"""Session helpers: defaults we rely on, and a shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of ours wants. Timestamps of the test tables are
# TIMESTAMP_NTZ and job bounds are epoch seconds, so the session zone is
# pinned to UTC (see SURVEY 7.4, "Time zone").
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[8]", app: str = "postroom", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = {
        **DEFAULTS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "16g",
        # many partition folders are listed by a job of so many tasks
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
        **conf,
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings we depend on in an existing session,
    and make this package importable by the session's Python workers."""
    for k, v in DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked conf: leave as the cluster set it
            pass
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (``addPyFile`` of
    a zip, once per SparkContext): functions run by ``mapInPandas`` and
    pandas UDFs are pickled by reference to their modules."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="postroom-pkg-"), "postroom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is set in a local run (tests) do we make our own: on a
    cluster a folder of one machine would not be seen by the others.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="postroom-ckpt-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/postroom-work/{name}-{uuid.uuid4().hex[:12]}"
