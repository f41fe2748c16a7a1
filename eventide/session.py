"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC for anything that crosses a zone
# boundary, AQE for runtime coalescing / skew splitting, Arrow for the few
# pandas-backed operators.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "eventide",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset; the launcher supplies it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Only when the session names none
    (local runs and tests) is a fresh scratch folder chosen and registered as
    the context's checkpoint directory.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def finished_ids(spark: SparkSession, base: str, name: str) -> list[int]:
    """Ids ``n`` of the folders ``<base>/<name>=<n>`` whose write has ended (Spark's success file is there)."""
    found = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}=*/_SUCCESS")
    files = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in files)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that an operator wrote and no reader needs any more."""
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``eventide`` importable in Python workers (``addPyFile`` of a zip).

    Needed by the operators that run Python code in tasks (`eventide.llm`);
    done once per SparkContext. The zip is built on the driver and
    distributed by Spark, like ``--py-files``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="eventide-pkg-"), "eventide.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
