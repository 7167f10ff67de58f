"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sitegrade.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["arrow_schema", "cut_lineage", "drop_folder", "ensure_checkpoint_dir", "map_batches",
           "shared_folder", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table, read by Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder of this name in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate rows that no later step reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark schema text (on the driver; tasks get the result)."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict | None]],
    schema: str,
    rows: int = 512,
) -> DataFrame:
    """Run ``make()`` once per task and its result on Arrow slices of ``rows`` rows.

    The function gets a record batch and returns columns by name (or None for no
    rows). Slices bound what a task holds besides one Arrow batch, whose bytes
    Spark bounds itself.
    """
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                columns = step(batch.slice(low, rows))
                if columns is not None:
                    arrays = [pa.array(columns[f.name], type=f.type) for f in arrow]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)
