"""Session settings and shared-storage scratch locations.

Query functions receive a session they did not build, so each one calls
:func:`configure` to pin what it relies on (UTC session zone, AQE, a state
store that supports the stateful stream operators).  Scratch output
(sinks written and read back, stream inputs, checkpoints) always lives
under the cluster's shared ``spark.checkpoint.dir``; a private directory
is only created when the session has none, as in unit tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings every query relies on.  Shuffle partition counts are left to the
# session (the cluster sizes them for its data); AQE coalesces and splits.
_SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin session settings the operators rely on; idempotent.

    A setting that the session refuses is raised: results would differ.
    """
    for key, value in _SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``layercake`` importable in Python workers (once per application).

    Stateful stream processors and Arrow UDF plug-ins are pickled by
    reference to this package, so workers must import it.  Deployments
    normally pass it with ``--py-files`` or install it; this is the
    in-session equivalent: the package's sources are zipped and added with
    ``SparkContext.addPyFile``, which Spark's file server distributes to
    every executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, archive = tempfile.mkstemp(prefix="layercake-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, names in os.walk(pkg):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only when neither is set (tests, a bare local
    session) is a private folder created and registered.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="layercake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/layercake/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the supplied Parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
