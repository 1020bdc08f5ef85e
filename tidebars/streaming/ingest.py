"""The daily increment as a file stream.

Each micro-batch runs the same plan, choice, cleaning and insert as the batch job on the files that
arrived since the last one. Insert-only sinks make a replayed batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidebars.plans.jobs import ingest_lines
from tidebars.sources import landing as landed
from tidebars.sources.tables import TableStore


def _stream(store: TableStore, path: str, rank: int) -> DataFrame:
    store.make_folder(path)  # a source that has no folder yet may get one later
    raw = store.spark.readStream.schema(landed.FILE_SCHEMA).options(**landed.CSV_OPTIONS).csv(path)
    return landed.file_lines(raw, rank)


def stream_increment(store: TableStore, landing: str, universe: DataFrame, run_end, checkpoint: str,
                     default_start: str | None = None):
    """Start the stream over all files available now; returns the query, which ends by itself.

    All files that arrived since the last run form one batch: what a symbol is read from, and from which
    day on, is decided over all of its files. The report of each batch is kept below the store's root.
    """
    primary = _stream(store, f"{landing}/primary", landed.PRIMARY)
    secondary = _stream(store, f"{landing}/secondary", landed.SECONDARY)

    def insert(batch: DataFrame, _: int) -> None:
        ingest_lines(store, lambda _: landed.number_lines(batch), universe, run_end, default_start)

    return (
        primary.unionByName(secondary)
        .writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
