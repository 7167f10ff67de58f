"""Session construction and the few cluster settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Engine settings that hold at any scale. AQE sizes shuffles, splits skewed
#: join partitions, and turns a join into a broadcast only after it has seen
#: the actual size of the side.
ENGINE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "sitegrade", master: str | None = None, **settings: str
) -> SparkSession:
    """Return a session carrying the engine settings, overridden by ``settings``.

    ``master`` stays unset on a cluster, where the submit command decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**ENGINE_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local masters."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    existing = context.getCheckpointDir()
    if existing:
        return existing
    if not context.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach"
        )
    folder = tempfile.mkdtemp(prefix="sitegrade-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    Used between the rounds of an iterative operator, so that a lost executor
    re-reads the last round instead of replaying every earlier one.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def stored_where_dealt(df: DataFrame) -> DataFrame:
    """As :func:`stored`; joins on more keys than both sides were dealt by leave the rows where they are.

    For tables dealt by a key whose groups are bounded, such as an entry.
    """
    spark = df.sparkSession
    before = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        return stored(df)
    finally:
        spark.conf.set(_ALL_KEYS, before)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it from there.

    For wide tables that several branches read by a few of their columns each:
    unlike :func:`cut_lineage` a reader decodes only the columns it needs, but
    how the rows were dealt and sorted is forgotten.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
