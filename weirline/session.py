"""Session helpers: the settings the engine relies on, and shipping its code to executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def build(app: str = "weirline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine needs: UTC, ANSI (plain decimal text), adaptive plans."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in (settings | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a local one only where unset and Spark is local itself."""
    set_ = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if set_:
        return set_.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = os.path.realpath(tempfile.mkdtemp(prefix="weirline-shared-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, where they can't import it themselves."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    # The driver serves this file for as long as the application runs.
    folder = os.path.realpath(tempfile.mkdtemp(prefix="weirline-code-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
