"""Session builder, table access and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC, AQE, skew join handling."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    return SparkSession.builder.master(master).config(map=settings).getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that any folder of this machine is shared."""
    return spark.sparkContext.master.split("[")[0] == "local"


def make_importable(spark: SparkSession) -> None:
    """Lets Python workers import this package, whatever their working folder: from where the driver has it, and on a
    cluster, whose machines may not have it there, from an archive that goes to each of them once."""
    context = spark.sparkContext
    if not _is_local(spark) and not getattr(context, "_millrace_sent", False):
        here = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="millrace-")  # the driver's own: Spark serves the archive from it
        atexit.register(shutil.rmtree, folder, True)
        context.addPyFile(shutil.make_archive(f"{folder}/millrace", "zip", os.path.dirname(here), os.path.basename(here)))
        context._millrace_sent = True
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it; one of our own only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isEmpty() and not _is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = current.get() if current.isDefined() else tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(folder) if current.isEmpty() else None
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """df, written as a table to the shared folder and read from there: what comes after neither computes it again
    nor carries its plan, and lost executors cost nothing of it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
