"""Session helpers: a tuned local session, and the shared folder for durable cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "millrace", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cpus) if str(cpus).isdigit() else "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the workers, which need it to load functions defined in it. Once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # addPyFile serves the file from the driver, so the driver's own folder does.
    path = os.path.join(tempfile.mkdtemp(), "millrace_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` wins, then a directory already set on the context. Only
    a local master may fall back to a folder of its own: on a cluster a machine-local
    folder would be lost with its executor, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = os.path.join(tempfile.gettempdir(), "millrace-checkpoints")
    context.setCheckpointDir(own)
    return own


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    root = checkpoint_root(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, for stream checkpoints and written tables."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _place(spark, path)
    fs.mkdirs(where)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder the library wrote itself; one that is gone already is fine."""
    fs, where = _place(spark, path)
    fs.delete(where, True)
