"""Sinks: materialise models as tables, publish model outputs, temp views.

Materialising is also how lineage is cut: a written table in shared storage
survives the loss of any executor, unlike cached blocks.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .tables import Store


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only when the
    session has none (local tests) is a scratch folder set up."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint dir and cut its lineage (a lost executor
    re-reads the files instead of recomputing the upstream plan). For inputs
    that several jobs or solver passes read. A Parquet table, not
    ``DataFrame.checkpoint``: that runs its last stage twice, and its result has
    no size for the planner to go by."""
    spark = df.sparkSession
    path = f"{checkpoint_base(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str, base: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` to ``{base}/{name}`` (default: under the checkpoint dir)
    and return a fresh scan of it, so downstream plans start from the table.
    For copies of one application's own; tables that others read are published
    (``tables.Store``)."""
    spark = df.sparkSession
    base = (base or os.path.join(checkpoint_base(spark), "tables")).rstrip("/")
    path = f"{base}/{name}"
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def bucketed(name: str, col: str, n: int):
    """A writer for ``Store.stage``: a table bucketed by ``col`` into ``n``
    buckets (one file each after one shuffle on the key). Tables bucketed alike
    on the same key are read co-partitioned: aggregations and joins on that key
    need no exchange."""

    def write(df: DataFrame, path: str) -> str:
        table = f"{name}_{hashlib.md5(path.encode()).hexdigest()[:10]}"
        df.repartition(n, col).write.format("parquet").bucketBy(n, col).option("path", path).saveAsTable(table)
        return table

    return write


def write_tables(spark: SparkSession, frames: dict[str, DataFrame], database: str) -> None:
    """Create or replace tables of a catalog's database, which is created if
    absent. Each is a new folder of files and a view on it: the view is replaced
    when all folders are complete, so readers never meet a half-written table,
    and a failed write leaves the former ones."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    store = Store(spark, spark.catalog.getDatabase(database).locationUri)
    staged = {name: store.stage(df, name) for name, df in frames.items()}
    for name, entry in staged.items():
        if spark.catalog.tableExists(f"`{database}`.`{name}`") and spark.catalog.getTable(f"`{database}`.`{name}`").tableType != "VIEW":
            spark.sql(f"DROP TABLE `{database}`.`{name}`")  # a table of earlier releases, replaced for good
        files = store.paths(name, entry)[0].replace("`", "``")
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM parquet.`{files}`")


def write_outputs(outputs: dict[str, DataFrame], database: str = "model_output", base: str | None = None) -> None:
    """Publish the model-output tables (metrics, coefficients, reference
    categories, thresholds): to the catalog, or under ``{base}/{database}``,
    where all of them change in one step."""
    spark = next(iter(outputs.values())).sparkSession
    if base is None:
        write_tables(spark, outputs, database)
        return
    store = Store(spark, f"{base.rstrip('/')}/{database}")
    store.publish({name: store.stage(df, name) for name, df in outputs.items()})


def register_views(frames: dict[str, DataFrame]) -> None:
    """Expose frames to ``spark.sql`` under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
