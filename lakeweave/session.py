"""Session construction and the shared folder used for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans shuffles at runtime (coalesces
# small partitions, splits skewed join partitions), dates are computed in UTC,
# and the Python worker path is Arrow-batched where it is used at all.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lakeweave", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster, pass no master and let spark-submit decide; locally tests
    pass ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app_name)
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
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (local tests) do we pick a fresh local folder and
    register it with ``SparkContext.setCheckpointDir`` (the config itself
    cannot change at runtime), so ``DataFrame.checkpoint()`` and written
    tables agree.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = sc.applicationId
        if app not in _LOCAL_FALLBACK:
            existing = sc.getCheckpointDir()
            _LOCAL_FALLBACK[app] = existing or tempfile.mkdtemp(prefix="lakeweave-ckpt-")
        d = _LOCAL_FALLBACK[app]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/lakeweave/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["get_session", "checkpoint_root", "shared_dir", "local_path", "DEFAULT_CONF"]
