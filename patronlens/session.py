"""Spark session with the settings the pipelines rely on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from threading import Lock

from pyspark import SparkContext
from pyspark.sql import SparkSession

PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def create_session(
    app_name: str = "patronlens",
    master: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session; cluster sizing (executors, shuffle partitions) stays with the caller."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PIPELINE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped_to: set[str] = set()
_shipping = Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers of the session, once, so that functions
    of the package run there whatever folder or host a worker starts in."""
    with _shipping:
        _ship_once(spark.sparkContext)


def _ship_once(context: SparkContext) -> None:
    if context.applicationId in _shipped_to:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="patronlens-modules-")) / "patronlens_modules.zip"
    with zipfile.ZipFile(archive, "w") as modules:
        for module in sorted(root.rglob("*.py")):
            modules.write(module, module.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped_to.add(context.applicationId)
