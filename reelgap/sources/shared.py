"""What the driver and all executors share: a folder and the package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; in local mode without one, a folder of this machine."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file://{tempfile.gettempdir()}/checkpoints"


def ship_package(spark: SparkSession) -> None:
    """Give Python workers the package, once per context, wherever the driver was started."""
    context = spark.sparkContext
    if "reelgap-package.zip" in getattr(context, "_python_includes", ()):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "reelgap-package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(package)))
    context.addPyFile(path)
