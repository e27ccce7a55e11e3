"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN_FOLDERS: dict[str, str] = {}

# Runtime settings the jobs rely on. All are per-session SQL settings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "pulsetrail", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = (builder.master(master).config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false"))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="pulsetrail-", dir="/tmp")
    return _OWN_FOLDERS[app]


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new sub-folder name for one run."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
