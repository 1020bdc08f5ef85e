"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import os
import pathlib
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


#: The folder of the run that is open in this thread, if any.
_RUN: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch_run", default=None)


def get_session(app: str = "tidebars", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time, adaptive execution and no web page; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever the driver was started."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext)


@functools.cache
def _ship(_application: str, context) -> None:
    package = pathlib.Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tidebars-py-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of a few driver-side rows that Spark holds as a local relation: no job, known size."""
    declared = T.StructType.fromDDL(schema)
    names = declared.names
    table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows], schema=to_arrow_schema(declared))
    return spark.createDataFrame(table, declared)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``, or in that of the open ``scratch_run``.

    Only a session that names no such folder (local tests) falls back to a temporary one.
    """
    base = _RUN.get() or spark.conf.get("spark.checkpoint.dir", None) or _local_base(spark)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex[:12]}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this library wrote; nothing happens if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch_run(spark: SparkSession, keep: bool = False):
    """Scratch tables that are written inside go at the end, also after an error, unless told to ``keep`` them.

    Frames are lazy: write what is wanted of them inside, to a path that was chosen outside.
    """
    folder = scratch_dir(spark, "run")
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        if not keep:
            remove_folder(spark, folder)


class Rounds:
    """Written tables of which each is made from the one before: that one goes once the next is complete."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self._last = spark, label, None

    def write(self, df: DataFrame) -> DataFrame:
        path = scratch_dir(self.spark, self.label)
        df.write.parquet(path)
        if self._last:
            remove_folder(self.spark, self._last)
        self._last = path
        return self.spark.read.schema(df.schema).parquet(path)


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidebars-{application}-")


def _local_base(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)
