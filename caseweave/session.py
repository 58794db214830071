"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import pathlib
import site
import tempfile
import uuid
import zipfile
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "caseweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for; ``conf`` overrides them.

    Partition counts stay with the cluster's own configuration and adaptive execution.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # a neighbour list or a long text is large; keep Arrow batches small
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="caseweave-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster a missing
    setting is an error, because a machine's own folder is lost with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def ship_package(spark: SparkSession) -> None:
    """Make this library importable in Python workers, for operators whose tasks import it.

    Does nothing if it is installed or on PYTHONPATH, which workers inherit; else it is sent along
    once per application.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    context = spark.sparkContext
    if root in map(os.path.abspath, filter(None, known)) or getattr(context, "_caseweave_sent", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="caseweave-"), "caseweave.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(pathlib.Path(root, "caseweave").rglob("*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(archive)
    context._caseweave_sent = True


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def store_stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and continue from the table.

    For results that several later jobs read: they are computed once, the table survives the
    loss of executors, and readers scan only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
