"""Scheduled refresh: pick up newly landed raw files, then rebuild.

The analysis itself is batch (the journey needs every event of a user), so
streaming is used only to notice files: per raw source a stream of file names
with ``trigger(availableNow=True)`` notes the files not seen before and stops;
its checkpoint (in shared storage) remembers them. Noted files that aren't
loaded yet are read by the headers of each, as any raw source is, and published
together with the list of what is loaded (``sources/tables.py``): a rerun after
a failure at any point neither skips nor repeats a file. The models are then
rebuilt from the raw tables and the checks gate publication.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ..plans import quality
from ..plans.build import Models, build_all
from ..sources.readers import read_csv_by_name
from ..sources.schemas import RAW_COLUMNS
from ..sources.tables import Store


def _note_landed(spark: SparkSession, landing: str, noted: str, checkpoint: str) -> DataFrame:
    """All file names of a landing folder that the stream has seen by now."""
    names = (
        spark.readStream.format("binaryFile")  # the path alone is asked for: contents are not read
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(landing)
        .select("path")
    )
    query = names.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(noted)
    query.awaitTermination()
    return spark.read.schema("path string").parquet(noted)


def ingest_new_files(spark: SparkSession, landing: str, name: str, raw_tables: str, checkpoints: str) -> Store:
    """Add the CSV files of ``{landing}/{name}/`` that aren't loaded yet to the
    table ``name`` of the store ``raw_tables``, which is returned. Columns go by
    the name in each file's header; a file that lacks one stops the run before
    anything is published, and is taken again by the next."""
    landed = _note_landed(spark, os.path.join(landing, name), os.path.join(raw_tables, f"{name}_landed"), os.path.join(checkpoints, f"landed_{name}"))
    store, files = Store(spark, raw_tables), f"{name}_files"
    if files in store.published():
        landed = landed.join(store.read(files), "path", "left_anti")
    paths = [r.path for r in landed.distinct().collect()]  # names of new files
    if paths:
        rows = read_csv_by_name(spark, [unquote(p) for p in paths], RAW_COLUMNS[name], f"raw source {name}")
        loaded = spark.createDataFrame([(p,) for p in paths], "path string")
        store.publish({name: store.stage_more(rows, name), files: store.stage_more(loaded, files)})
    return store


def scheduled_refresh(spark: SparkSession, landing: str, warehouse: str, user_buckets: int | None = None) -> Models:
    """One scheduled run: ingest new files of all four sources, rebuild all
    models as tables under ``{warehouse}/models``, and raise if any check
    fails (readers then keep the models of the last run that passed)."""
    raw_tables = os.path.join(warehouse, "raw")
    checkpoints = os.path.join(warehouse, "_checkpoints")
    raw = {}
    for name in RAW_COLUMNS:
        raw[name] = ingest_new_files(spark, landing, name, raw_tables, checkpoints).read(name)

    return build_all(raw, base=os.path.join(warehouse, "models"), checks=quality.gate_model, user_buckets=user_buckets)
