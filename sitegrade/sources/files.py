"""Entry files: enumeration, choice among candidates, and text scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegrade import vocab
from sitegrade.functions.clean import blank_if_missing
from sitegrade.functions.ids import entry_id_from_path, is_entry_id, residue_id, residue_sequence
from sitegrade.operators.prefix import ordinal_within, segment_index

#: File kinds of an entry and their suffixes, best first (fixed formats).
FILE_CHOICES = {
    "mtz": ("_final.mtz", "_final.mtz.gz"),
    "coordinates": ("_final.cif", "_final.cif.gz", "_final.pdb", "_final.pdb.gz"),
    "metadata": ("data.json", "data.json.gz"),
}
WEB_PREFIXES = ("<!doctype", "<html", "<?xml")
MAX_WEB_PAGE_BYTES = 1024 * 1024
#: Bytes of a file's start that are looked at.
PROBE_BYTES = 64


def list_files(spark: SparkSession, root: str, *, probe: bool = False) -> DataFrame:
    """Files under a sharded tree: ``path, length, entry_id, shard``, and the first bytes.

    Only the listing is read unless ``probe`` asks for file starts; then only
    files small enough to be served pages are opened, others have a null head.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    parts = F.split("path", "/")
    folder = F.try_element_at(parts, F.lit(-2))
    columns = [
        F.col("path"), F.col("length"), F.lower(folder).alias("entry_id"),
        F.try_element_at(parts, F.lit(-3)).alias("shard"),
    ]
    named = is_entry_id("entry_id") & (F.col("shard") == F.substring("entry_id", 2, 2))
    if not probe:
        return listed.select(*columns).where(named)
    # the length filter reaches the file source, which then never opens larger files
    start = F.substring("content", 1, PROBE_BYTES).cast("string").alias("head")
    small = listed.where(F.col("length") <= MAX_WEB_PAGE_BYTES).select(*columns, start)
    large = listed.where(F.col("length") > MAX_WEB_PAGE_BYTES).select(
        *columns, F.lit(None).cast("string").alias("head"))
    return small.unionByName(large).where(named)


def looks_like_page(head: str | Column, length: str | Column) -> Column:
    """Whether a small file starts like a served web document."""
    start = F.lower(F.regexp_replace(F.col(head) if isinstance(head, str) else head, r"^\s+", ""))
    size = F.col(length) if isinstance(length, str) else length
    page = F.lit(False)
    for prefix in WEB_PREFIXES:
        page = page | F.coalesce(start.startswith(prefix), F.lit(False))
    return page & (size <= MAX_WEB_PAGE_BYTES)


def usable(head: str | Column, length: str | Column) -> Column:
    """Whether a file holds data: not empty and no web page."""
    size = F.col(length) if isinstance(length, str) else length
    return (size > 0) & ~looks_like_page(head, length)


def with_choice(files: DataFrame) -> DataFrame:
    """Add ``kind`` and ``priority`` of every recognised file name."""
    kind, priority = F.lit(None).cast("string"), F.lit(None).cast("int")
    for name, suffixes in FILE_CHOICES.items():
        for rank, suffix in enumerate(suffixes):
            match = F.col("path").endswith(suffix)
            kind = F.when(match, F.lit(name)).otherwise(kind)
            priority = F.when(match, F.lit(rank)).otherwise(priority)
    return files.withColumns({"kind": kind, "priority": priority}).where("kind IS NOT NULL")


def best_files(files: DataFrame) -> DataFrame:
    """The best file per entry and kind; unusable ones were dropped before."""
    return files.groupBy("entry_id", "kind").agg(
        F.min_by("path", F.struct("priority", "path")).alias("path")
    )


def complete_entries(files: DataFrame, limit: int | None = None) -> DataFrame:
    """Sorted ids of entries that have both coordinates and reflections."""
    kinds = files.groupBy("entry_id").agg(
        F.bool_or(F.col("kind") == "mtz").alias("mtz"),
        F.bool_or(F.col("kind") == "coordinates").alias("coordinates"),
    ).where("mtz AND coordinates").select("entry_id").orderBy("entry_id")
    return kinds if limit is None else kinds.limit(limit)


def id_tokens(texts: DataFrame, text: str = "value") -> DataFrame:
    """Ids of list texts: comments cut, tokens split, first places kept.

    Returns ``token, valid, first_at``; a job refuses a list with invalid ones.
    """
    cleaned = F.regexp_replace(F.regexp_replace(text, "^﻿", ""), r"#[^\n]*", " ")
    tokens = texts.select(F.posexplode(F.split(cleaned, r"[,\s]+")).alias("at", "token")).where(
        F.col("token") != ""
    )
    named = F.when(is_entry_id("token"), F.lower("token")).otherwise(F.col("token"))
    return tokens.groupBy(named.alias("token")).agg(
        F.bool_or(is_entry_id(F.col("token"))).alias("valid"), F.min("at").alias("first_at")
    )


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of one list file."""
    return id_tokens(spark.read.text(path, wholetext=True))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of whole files: ``path, entry_id, position, line``."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )
    return files.select(
        "path", entry_id_from_path("path").alias("entry_id"),
        F.posexplode(F.split("value", r"\r?\n")).alias("position", "line"),
    )


def atom_records(lines: DataFrame, keys: tuple[str, ...] = ("entry_id",)) -> DataFrame:
    """Fixed-width coordinate records: model, identity, occupancy and element text.

    ``lines`` carries ``position`` and ``line``. The first MODEL line opens
    model 0; each later one opens the next.
    """
    record = F.upper(F.trim(F.substring("line", 1, 6)))
    kept = lines.withColumn("record", record).where(
        F.col("record").isin("MODEL", "ATOM", "HETATM")
    ).withColumn("is_model", F.col("record") == "MODEL")
    numbered = segment_index(kept, list(keys), "position", "is_model", "models")
    atoms = numbered.where(~F.col("is_model")).withColumn(
        "model_index", F.greatest(F.col("models") - 1, F.lit(0)).cast("int")
    )
    cut = lambda start, size: F.trim(F.substring("line", start, size))
    fields = atoms.select(
        *keys, "position", "model_index",
        cut(7, 5).try_cast("int").alias("serial"),
        cut(13, 4).alias("atom_name"),
        blank_if_missing(F.substring("line", 17, 1)).alias("altloc"),
        cut(18, 3).alias("residue_name"),
        cut(21, 2).alias("chain_id"),
        residue_sequence(F.substring("line", 23, 4)).alias("residue_number"),
        blank_if_missing(F.substring("line", 27, 1)).alias("insertion_code"),
        cut(55, 6).alias("occupancy_raw"),
        cut(77, 2).alias("element"),
    )
    return ordinal_within(fields, [*keys, "model_index"], "position", "source_order")


# ---- residue statistics --------------------------------------------------------
_STEMS = ("BA", "NP", "R", "RG", "SRG", "CCS", "CCP", "ZCCP", "ZO", "ZD", "ZD-", "ZD+")
METRICS = tuple(stem + group for group in ("m", "s", "a") for stem in _STEMS)
STATISTICS_COLUMNS = ("RT", "CI", "RN", *METRICS, "MN", "CP", "NR")
_CP_PLACE = STATISTICS_COLUMNS.index("CP") + 1
_COUNT_METRICS = ("NPm", "NPs", "NPa")


def statistics_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of residue-statistics tables, and the lines that break their format.

    ``lines`` carries ``entry_id, position, line``. The header must match in
    full; separator rows are skipped; a row one field short before its row
    number lacks a blank chain, which is put back; ``****`` in a grid-point
    count is an overflow and reads as null.
    """
    fields = F.split(F.trim("line"), r"\s+")
    written = lines.where(F.trim("line") != "")
    width = len(STATISTICS_COLUMNS)
    heading = F.trim("line").startswith(STATISTICS_COLUMNS[0]) & (
        F.regexp_replace(F.trim("line"), r"\s+", " ") == " ".join(STATISTICS_COLUMNS))
    headers = written.select("entry_id", "position", heading.alias("heading")).groupBy("entry_id").agg(
        F.min("position").alias("header_at"), F.min_by("heading", "position").alias("header_ok"))
    split = written.withColumn("fields", fields)
    size = F.size("fields")
    separator = (F.array_join("fields", " ") == "_") | (
        (size == len(METRICS) + 3)
        & (F.get("fields", F.lit(0)) == "_")
        & F.forall(F.slice("fields", 2, len(METRICS)), lambda v: F.lower(v) == "n/a")
        & F.forall(F.slice("fields", -2, 2), lambda v: v.rlike(r"^\d+$"))
    )
    whole = r"^[+-]?\d+$"
    short = (
        (size == width - 1)
        & F.get("fields", F.lit(width - 3)).rlike(whole)
        & F.get("fields", F.lit(width - 2)).rlike(whole)
    )
    body = split.where(~separator).withColumn(
        "fields",
        F.when(short, F.array_insert("fields", _CP_PLACE, F.lit(""))).otherwise(F.col("fields")),
    )
    named = body.select(
        "entry_id", "position", "line", F.size("fields").alias("size"),
        *[F.get("fields", F.lit(i)).alias(f"t_{c}") for i, c in enumerate(STATISTICS_COLUMNS)],
    )
    metric_text = {
        c: F.when((F.col(f"`t_{c}`") == "****") & F.lit(c in _COUNT_METRICS), F.lit("n/a")).otherwise(
            F.col(f"`t_{c}`")
        )
        for c in METRICS
    }
    bad_metric = F.lit(False)
    for c in METRICS:
        readable = (F.lower(metric_text[c]) == "n/a") | metric_text[c].rlike(
            r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
        )
        bad_metric = bad_metric | ~F.coalesce(readable, F.lit(False))
    number = F.col("t_NR").try_cast("int")
    problem = (
        F.when(F.col("size") != width, F.lit("wrong_field_count"))
        .when(bad_metric, F.lit("nonnumeric_metric"))
        .when(F.col("t_MN").try_cast("int").isNull(), F.lit("invalid_model"))
        .when(number.isNull() | (number < 1), F.lit("invalid_row_number"))
        .when(residue_id("t_RN").isNull(), F.lit("invalid_residue_id"))
    )
    blank = lambda c: F.when(F.col(c).isin("", ".", "?", "_"), F.lit("")).otherwise(F.col(c))
    # lines are read before they meet their header, so the join moves values, not split texts
    read = named.select(
        "entry_id", "position", "line", problem.alias("problem"),
        F.col("t_RT").alias("RT"), blank("t_CI").alias("CI"), residue_id("t_RN").alias("RN"),
        *[
            F.when(F.lower(metric_text[c]) != "n/a", metric_text[c].try_cast("double")).alias(c)
            for c in METRICS
        ],
        F.col("t_MN").try_cast("int").alias("MN"), blank("t_CP").alias("CP"), number.alias("NR"),
        F.greatest(*[F.col(f"`t_{c}`") == "****" for c in _COUNT_METRICS]).alias("overflow"),
    )
    judged = read.join(headers, "entry_id").where(F.col("position") > F.col("header_at")).withColumn(
        "problem", F.when(~F.col("header_ok"), F.lit("invalid_header")).otherwise(F.col("problem")))
    return judged.where(F.col("problem").isNull()).drop("line", "problem", "header_at", "header_ok"), (
        judged.where(F.col("problem").isNotNull()).select("entry_id", "position", "line", "problem"))


def literature_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of a distance table and the lines it must not contain.

    Comments, blanks and the header are skipped. A line with the wrong number
    of fields, unreadable or non-positive values, or a repeated key is rejected.
    """
    fields = F.split(F.trim("line"), r"\s+")
    header = F.lit("residue atom metal avg_bond_dist st_dev")
    kept = lines.where(
        (F.trim("line") != "") & ~F.trim("line").startswith("#")
        & (F.array_join(fields, " ") != header)
    ).withColumn("fields", fields)
    number = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    parsed = kept.select(
        "position", "line", F.size("fields").alias("size"),
        *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(("residue", "donor", "metal"))],
        *[
            F.when(F.get("fields", F.lit(i)).rlike(number), F.get("fields", F.lit(i)).try_cast("double")).alias(c)
            for i, c in ((3, "mu"), (4, "sigma"))
        ],
    )
    problem = (
        F.when(F.col("size") != 5, F.lit("wrong_field_count"))
        .when(F.col("mu").isNull() | F.col("sigma").isNull(), F.lit("unreadable_value"))
        .when((F.col("mu") <= 0) | (F.col("sigma") <= 0), F.lit("non_positive_value"))
    )
    judged = parsed.withColumn("problem", problem)
    first = judged.where("problem IS NULL").groupBy("residue", "donor", "metal").agg(
        F.min("position").alias("first_at")
    )
    placed = judged.join(first, ["residue", "donor", "metal"], "left").withColumn(
        "problem",
        F.coalesce("problem", F.when(F.col("position") > F.col("first_at"), F.lit("duplicate_key"))),
    )
    rows = placed.where("problem IS NULL").select("residue", "donor", "metal", "mu", "sigma")
    return rows, placed.where("problem IS NOT NULL").select("position", "line", "problem")


CATALOG_SCHEMA = "component_id string, formula string, structural_class string"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The tab-separated component catalog; blank ids are skipped."""
    table = spark.read.schema(CATALOG_SCHEMA).option("sep", "\t").csv(path)
    return table.where(F.trim("component_id") != "").fillna("", ["formula", "structural_class"])


# ---- JSON ----------------------------------------------------------------------
def properties(df: DataFrame, text: str, schema: str, *, strict: bool = False) -> DataFrame:
    """Typed properties of a JSON text column; bad JSON is null, or stops a strict job."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return df.withColumn("properties", F.from_json(text, schema, {"mode": mode}))


PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("pdb_id", T.StringType()),
        T.StructField("metadata_source", T.StringType()),
        T.StructField("retrieved_at_utc", T.StringType()),
        T.StructField("entry_revision_date", T.StringType()),
        T.StructField("entry_available", T.BooleanType()),
        T.StructField(
            "conditions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(name, T.StringType())
                        for name in ("crystal_id", "method", "temp", "pH", "pdbx_pH_range",
                                     "pdbx_details", "temp_details")
                    ]
                )
            ),
        ),
    ]
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Cached metadata payloads with the id their file name asks for."""
    raw = spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", True).option(
        "recursiveFileLookup", True
    ).json(path)
    return raw.select(
        entry_id_from_path("_metadata.file_path").alias("requested_id"),
        F.lower("pdb_id").alias("entry_id"),
        *[f.name for f in PAYLOAD_SCHEMA.fields if f.name != "pdb_id"],
    )


def provenance(props: str = "properties") -> dict[str, Column]:
    """Twin flag, version and date; only a JSON ``true`` is a twin."""
    return {
        "is_twin": F.coalesce(F.col(f"{props}.ISTWIN"), F.lit(False)),
        "source_version": F.trim(F.coalesce(F.col(f"{props}.VERSION"), F.lit(""))),
        "source_date": F.trim(F.coalesce(F.col(f"{props}.TIME"), F.lit(""))),
    }
