"""Session helpers: the shared working folder and the settings this package reads."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

#: Rows of one ordered group that a single task may hold (see ``plans.ordered``).
SLICE_WIDTH = "spark.logweave.sliceWidth"
DEFAULT_SLICE_WIDTH = 1 << 20


def slice_width(spark: SparkSession) -> int:
    return int(spark.conf.get(SLICE_WIDTH, str(DEFAULT_SLICE_WIDTH)))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="logweave-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/logweave-{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers; once per application.

    Functions handed to ``applyInPandas`` and friends refer to modules of the package, which a
    worker on another machine does not have unless it was installed there.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="logweave-code-"), "logweave.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
