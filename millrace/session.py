"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Runtime settings the operators are written for. Sizes are the cluster's to raise;
# nothing here depends on the volume of data.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # counts of a run are added up from the reports of all its batches
    "spark.sql.streaming.numRecentProgressUpdates": "100000",
}


def build_session(
    app: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """Start (or reuse) a session with the library's settings; the UI stays off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = {**RUNTIME_SETTINGS, "spark.ui.enabled": "false", **(settings or {})}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the library's runtime settings on a session somebody else made."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path not used before, under the folder named by ``spark.checkpoint.dir``.

    Executors on other machines must see the folder. A session that names none gets one in
    its warehouse, which executors share as well, unless that lies on a cluster's local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        local = "://" not in warehouse or warehouse.startswith("file:")
        if local and not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master")):
            raise ValueError(f"set spark.checkpoint.dir to a folder all executors share; {warehouse} is local")
        root = f"{warehouse.rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"
