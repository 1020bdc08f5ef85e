"""Columns by exact name, results beside them, and tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidebars.session import scratch_dir, ship_package

#: Rows that a Python worker gets at a time; a row holds a whole text.
BATCH_ROWS = 1_000


def _places(df: DataFrame) -> DataFrame:
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def _place(df: DataFrame, name: str) -> str:
    if name not in df.columns:
        raise ValueError(f"no column {name}; there are {df.columns}")
    return f"c{df.columns.index(name)}"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone. Names are exact and the first column of a name counts, so that other columns may be
    called anything, ``TEXT`` beside ``text`` too."""
    return _places(df).select(*(F.col(_place(df, n)).alias(n) for n in names))


def beside(df: DataFrame, inputs: list[str], build: Callable[..., Column]) -> DataFrame:
    """The columns of ``df`` under the names c0, c1, ... and ``made``, the column ``build(*inputs)``: nothing can clash."""
    flat = _places(df)
    return flat.withColumn("made", build(*(F.col(_place(df, n)) for n in inputs)))


def restore(flat: DataFrame, names: list[str]) -> DataFrame:
    """The columns c0, c1, ... of ``beside`` under their names again."""
    return flat.select(*(F.col(f"c{i}") for i in range(len(names)))).toDF(*names)


def with_results(df: DataFrame, inputs: list[str], build: Callable[..., Column], results: list[str]) -> DataFrame:
    """All columns of ``df``, then the fields ``results`` of the struct that ``build(*inputs)`` makes.

    A column of ``df`` that is called like a result, in whatever case, gives way to it.
    """
    taken = {r.lower() for r in results}
    keep = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in taken]
    return beside(df, inputs, build).select(*keep, *(F.col(f"made.{r}").alias(r) for r in results))


def appended(df: DataFrame, inputs: list[str], make: Callable[..., tuple], fields: str, rows: int = 256) -> DataFrame:
    """All columns of ``df``, then ``fields``, which ``make`` computes from the Arrow arrays of ``inputs``, ``rows`` rows at a
    time. A column of ``df`` that is called like a field, in whatever case, gives way to it."""
    added = T.StructType.fromDDL(fields)
    flat, places = _places(df), [df.columns.index(n) for n in inputs if _place(df, n)]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                columns = [*part.columns, *make(*(part.column(p) for p in places))]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(part.columns))] + added.names)

    made = flat.mapInArrow(run, T.StructType([*flat.schema.fields, *added.fields]))
    taken = {n.lower() for n in added.names}
    keep = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in taken]
    return made.select(*keep, *added.names)


def prepare(spark: SparkSession) -> None:
    """Give the Python workers this package, and small batches."""
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def settle(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: it cuts the lineage, outlives lost executors and
    is computed once."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the third of all ids that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
