"""Fixed-schema tables: checked readers, the CSV export, frozen distributions."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegrade import vocab
from sitegrade.operators import distribution as dist
from sitegrade.operators.runs import (
    header_difference, manifest_provenance, software_versions, status_counts,
)
from sitegrade.plans.score import ANALYSIS_COLUMNS, POLICY_JSON

#: Columns a prepared score-input table must carry.
REQUIRED_SCORE_INPUTS = (
    "entry_id", "metal_site_id", "rszd_abs", "geometry_rms_zbond", "context_warning",
    "context_warning_reasons", "score_inputs_status",
)
DISTRIBUTION_SCHEMA = "component string, value double, count long"
METADATA_SCHEMA = (
    "reference_id string, cohort_id string, policy string, fingerprint string,"
    " input_row_count long, input_entry_count long, scorable_entry_count long,"
    " density_reference_size long, geometry_reference_size long,"
    " density_distinct_value_count long, geometry_distinct_value_count long,"
    " analysis_config_id string, source_entry_count long, no_metals_entry_count long,"
    " metal_site_limit_exceeded_entry_count long, metal_bearing_entry_count long,"
    " status_counts map<string,long>, input_status_counts map<string,long>,"
    " software map<string,string>"
)
#: Metadata a manifest gives; null when a cohort is frozen without one.
MANIFEST_FIELDS = (
    "analysis_config_id", "source_entry_count", "no_metals_entry_count",
    "metal_site_limit_exceeded_entry_count", "metal_bearing_entry_count", "status_counts", "software",
)


class TableError(ValueError):
    """A table does not have the form its reader needs."""


def assert_schema(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``df`` in the given column order; a missing, extra or repeated column is refused."""
    repeated = sorted({c for c in columns if list(columns).count(c) > 1})
    if repeated:
        raise TableError(f"{label} column list repeats: {', '.join(repeated)}")
    difference = header_difference(sorted(df.columns), sorted(columns))
    if difference:
        raise TableError(f"{label} does not match its schema: {difference}")
    return df.select(*columns)


def validate_score_inputs(df: DataFrame) -> DataFrame:
    """Refuse score inputs that lack a column or were scored already."""
    missing = [c for c in REQUIRED_SCORE_INPUTS if c not in df.columns]
    if missing:
        raise TableError("score inputs are missing required columns: " + ", ".join(missing))
    if any(c in df.columns for c in ANALYSIS_COLUMNS):
        raise TableError("score inputs already contain analysis columns")
    return df


def as_text(df: DataFrame) -> DataFrame:
    """Cells as published text: true/false, blank for missing, arrays by pipes."""
    cells = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            cell = F.array_join(F.transform(column, lambda v: F.coalesce(v.cast("string"), F.lit(""))), "|")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            bad = F.isnan(column) | (F.abs(column) == float("inf"))
            cell = F.when(~bad, column.cast("string"))
        else:
            cell = column.cast("string")
        cells.append(F.coalesce(cell, F.lit("")).alias(field.name))
    return df.select(*cells)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Export a table as CSV text in a fixed column order."""
    table = df if columns is None else assert_schema(df, columns, path)
    as_text(table).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read an exported table back with its schema; the header is enforced."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


# ---- frozen distributions ------------------------------------------------------
def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def metadata_path(folder: str) -> str:
    return f"{folder}/metadata"


def manifest_metadata(
    manifest: DataFrame, software: Sequence[str] = (), config_id: str | None = None
) -> dict:
    """What a manifest says of a cohort: one row of counts, statuses, software.

    Refused: rows of no or of several configurations, rows of another
    configuration than ``config_id``, and several versions of one software.
    """
    row = manifest_provenance(manifest).first().asDict()
    if not row.pop("single_configuration"):
        raise TableError("manifest rows do not share exactly one analysis_config_id")
    if config_id is not None and row["analysis_config_id"] != config_id:
        raise TableError("manifest was made with another analysis_config_id")
    versions = (
        software_versions(manifest, software).groupBy("software")
        .agg(F.min("version").alias("low"), F.max("version").alias("high")).collect()
        if software else []  # one row per software column
    )
    mixed = sorted(r["software"] for r in versions if r["low"] != r["high"])
    if mixed:
        raise TableError("manifest rows mix versions of " + ", ".join(mixed))
    # the status vocabulary is closed: at most one row per status
    counts = status_counts(manifest.where(F.col("status").isin(*vocab.ENTRY_STATUSES))).collect()
    return {
        **row,
        "status_counts": {r["status"]: r["count"] for r in counts},
        "software": {r["software"]: r["low"] for r in versions},
    }


def write_reference(inputs: DataFrame, folder: str, provenance: dict | None = None) -> DataFrame:
    """Freeze a cohort's distribution under ``folder`` and return its metadata row.

    ``provenance`` is what :func:`manifest_metadata` returns.
    The metadata is the completion marker: a stale one is removed first and the
    new one written last, so a failed run leaves a folder no reader accepts.
    """
    spark = inputs.sparkSession
    target, system = _hadoop_path(spark, metadata_path(folder))
    system.delete(target, True)
    dist.value_histogram(inputs).orderBy("component", "value").write.mode("overwrite").parquet(
        f"{folder}/distribution"
    )
    frozen = spark.read.schema(DISTRIBUTION_SCHEMA).parquet(f"{folder}/distribution")
    if frozen.isEmpty():
        raise TableError("cannot build a score reference with no evidence")
    # Three one-row results make up the metadata.
    fingerprint = dist.fingerprint(frozen, POLICY_JSON).first()["fingerprint"]
    values = {
        **dist.cohort_summary(inputs).first().asDict(),
        **_size_row(frozen).first().asDict(),
        "policy": POLICY_JSON,
        "fingerprint": fingerprint,
        "reference_id": f"score-ref-{fingerprint[:20]}",
    }
    values["cohort_id"] = _cohort_id(values["reference_id"], inputs)
    names = T.StructType.fromDDL(METADATA_SCHEMA).names
    statuses = dist.status_histogram(inputs).where(
        F.col("status").isin(*vocab.SCORE_INPUT_STATUSES)).collect()
    values["input_status_counts"] = {r["status"]: r["count"] for r in statuses}
    values |= dict.fromkeys(MANIFEST_FIELDS) | (provenance or {})
    spark.createDataFrame([tuple(values[n] for n in names)], METADATA_SCHEMA).coalesce(1).write.mode(
        "overwrite"
    ).json(metadata_path(folder))
    return spark.read.schema(METADATA_SCHEMA).json(metadata_path(folder))


def _cohort_id(reference_id: str, inputs: DataFrame) -> str:
    identity = f"{reference_id}\n{_rows_digest(inputs)}"
    return "cohort-" + hashlib.sha256(identity.encode()).hexdigest()[:20]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system Spark knows."""
    target, system = _hadoop_path(spark, path)
    return bool(system.exists(target))


def frozen_cohort(spark: SparkSession, folder: str, inputs_path: str) -> dict | None:
    """The metadata of the reference under ``folder`` if it was made of exactly these inputs."""
    if not exists(spark, metadata_path(folder)):
        return None
    row = spark.read.schema(METADATA_SCHEMA).json(metadata_path(folder)).first()
    if row is None or row["cohort_id"] != _cohort_id(row["reference_id"], spark.read.parquet(inputs_path)):
        return None
    return row.asDict()


def _rows_digest(inputs: DataFrame) -> str:
    """Identity of a cohort's rows in any order: sums of two 64-bit hashes and a count."""
    columns = sorted(c for c, kind in inputs.dtypes if not kind.startswith("map"))
    wide = "decimal(38,0)"
    row = inputs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(F.lit("a"), *columns).cast(wide)).alias("a"),
        F.sum(F.xxhash64(F.lit("b"), *columns[::-1]).cast(wide)).alias("b"),
    ).first()
    return f"{row['n']}:{row['a']}:{row['b']}"


def _size_row(distribution: DataFrame) -> DataFrame:
    """One row with sizes and distinct counts of both components."""
    return distribution.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("component") == c, F.col("count"))), F.lit(0)).alias(f"{c}_reference_size")
            for c in dist.COMPONENTS
        ],
        *[
            F.count_if(F.col("component") == c).alias(f"{c}_distinct_value_count")
            for c in dist.COMPONENTS
        ],
    )


def load_reference(spark: SparkSession, folder: str) -> tuple[DataFrame, dict]:
    """A frozen distribution and its metadata, after every check it must pass."""
    target, system = _hadoop_path(spark, metadata_path(folder))
    if not system.exists(target):
        raise TableError(f"no completed score reference under {folder}")
    row = spark.read.schema(METADATA_SCHEMA).json(metadata_path(folder)).first()
    if row is None:
        raise TableError("score reference metadata is empty")
    metadata = row.asDict()
    if metadata["policy"] != POLICY_JSON:
        raise TableError("score reference policy is incompatible with this code")
    if not (metadata["cohort_id"] or "").startswith("cohort-"):
        raise TableError("score reference has no valid cohort identifier")
    frozen = spark.read.schema(DISTRIBUTION_SCHEMA).parquet(f"{folder}/distribution")
    broken = dist.violations(frozen).limit(1).collect()
    if broken:
        raise TableError(f"score reference breaks rule {broken[0]['rule']}")
    if dist.fingerprint(frozen, POLICY_JSON).first()[0] != metadata["fingerprint"]:
        raise TableError("score reference identifier does not match data")
    for name, value in _size_row(frozen).first().asDict().items():
        if metadata[name] != value:
            raise TableError(f"score reference {name} does not match metadata")
    largest = max(metadata["density_reference_size"], metadata["geometry_reference_size"])
    if metadata["input_row_count"] < largest:
        raise TableError("score reference cohort is smaller than its evidence")
    return frozen, metadata


def validate_scored(scores: DataFrame, metadata: dict) -> None:
    """Refuse stored scores made with another reference or cohort."""
    for column, key in (("score_reference_id", "reference_id"), ("score_cohort_id", "cohort_id")):
        if column not in scores.columns:
            raise TableError(f"existing scores have no {column}")
        value = F.trim(F.coalesce(column, F.lit("")))
        row = scores.agg(
            F.count_if(value == "").alias("blank"),
            F.count_if((value != "") & (value != metadata[key])).alias("other"),
        ).first()
        if row["blank"]:
            raise TableError(f"existing scores have a blank {column}")
        if row["other"]:
            raise TableError(f"existing scores use a different {key}")


def require_tables(spark: SparkSession, expected: dict[str, Sequence[str]]) -> None:
    """Refuse to append below tables that are absent or have another header."""
    for path, columns in expected.items():
        target, system = _hadoop_path(spark, path)
        if not system.exists(target):
            raise TableError(f"{path} is missing")
        difference = header_difference(spark.read.parquet(path).columns, columns)
        if difference:
            raise TableError(f"{path} uses an incompatible schema ({difference})")
