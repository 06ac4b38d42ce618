"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates, ANSI arithmetic guarded by
# try_divide, adaptive execution for runtime broadcast/skew/coalescing.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelfwise", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster call it without ``master``; the launcher decides.  Tests
    and the local bench pass ``local[N]`` and a small shuffle width.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - a remote session has no SparkContext
        pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
    folder; it is always honoured.  Only when nothing is configured on a
    ``local`` master (unit tests, a laptop) do we fall back to a fresh folder
    under /tmp; on any other master a missing setting is an error, for tables
    in a machine's own folder would be lost to the other machines.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext; the server's setting applies
        sc = None
    if sc is None:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a remote session")
        return conf_dir
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        conf_dir = tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application.

    Python functions of the package run on executors by import.  A launcher
    may install it there or pass ``--py-files``; this does the same for
    sessions that were started without either.
    """
    app = app_id(spark)
    if app in _SHIPPED:
        return
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions get the package from their server
        return
    import shutil
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="shelfwise-package-"), "shelfwise")
    sc.addPyFile(shutil.make_archive(name, "zip", root, "shelfwise"))
    _SHIPPED.add(app)


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (session id on Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return str(getattr(spark, "session_id", "remote"))


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "shelfwise", *parts)
