"""Atom records: occupancy and element audit, duplicates, conformers, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import NUMBER_PATTERN, finite, first_label, labels
from sitegrade.functions.geometry import distance
from sitegrade.functions.rounding import with_rounded
from sitegrade.operators.prefix import exact_median, running_best

RESIDUE = ("entry_id", "model_index", "chain_index", "residue_index")
#: Conformer before atom: one sort by identity also orders records by residue and conformer.
EXACT_IDENTITY = (*RESIDUE, "altloc", "atom_name", "element_key")
CHEMICAL_SITE = (*RESIDUE, "atom_name", "element_key")


def with_occupancy(atoms: DataFrame, raw: str = "occupancy_raw") -> DataFrame:
    """Add ``occupancy``, ``occupancy_valid`` and ``occupancy_status`` from deposited text."""
    text = F.trim(F.coalesce(F.col(raw), F.lit("")))
    parsed = atoms.withColumns(
        {
            "occupancy": finite(
                F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
            ),
            "__text": text,
        }
    )
    value = F.col("occupancy")
    status = first_label(
        [
            (F.col("__text") == "", "missing"),
            (F.col("__text").rlike(r"(?i)^[+-]?(nan|inf|infinity)$"), "invalid_non_finite"),
            (~F.col("__text").rlike(NUMBER_PATTERN), "invalid_non_numeric"),
            (value.isNull(), "invalid_non_finite"),
            ((value < 0) | (value > 1), "invalid_range"),
        ],
        "valid",
    )
    return parsed.withColumn("occupancy_status", status).withColumn(
        "occupancy_valid", F.col("occupancy_status") == "valid"
    ).drop("__text")


def with_element(atoms: DataFrame, raw: str = "element") -> DataFrame:
    """Validate the deposited element; names of atoms are never a substitute."""
    symbol = F.upper(F.trim(F.coalesce(F.col(raw), F.lit(""))))
    known = symbol.isin(*vocab.ELEMENTS)
    return atoms.withColumns(
        {
            "element_status": first_label(
                [(symbol == "", "missing"), (~known, "invalid")], "valid"
            ),
            "element": F.when(known, symbol),
            "element_key": F.when(known, symbol).otherwise(F.lit("")),
            "is_hydrogen": known & symbol.isin(*vocab.HYDROGENS),
        }
    )


def unmapped(atoms: DataFrame, matched: str) -> DataFrame:
    """Mark atoms whose source record was not found: their occupancy cannot be trusted."""
    return atoms.withColumns(
        {
            "occupancy_status": F.when(F.col(matched), F.col("occupancy_status")).otherwise(
                F.lit("raw_mapping_failed")
            ),
            "occupancy_valid": F.col("occupancy_valid") & F.col(matched),
        }
    )


def first_model(atoms: DataFrame) -> DataFrame:
    """Atoms of the first model only."""
    return atoms.where(F.col("model_index") == 0)


def model_counts(atoms: DataFrame) -> DataFrame:
    """Models per entry, kept beside the first-model selection."""
    return atoms.groupBy("entry_id").agg(
        F.count_distinct("model_index").alias("input_model_count"),
    ).withColumn("multi_model_structure", F.col("input_model_count") > 1)


def record_order() -> list[Column]:
    """Order of competing records: valid first, higher occupancy, source order."""
    valid = F.col("occupancy_valid")
    return [
        (~valid).alias("invalid"),
        F.when(valid, -F.col("occupancy")).alias("negated"),
        F.col("source_order").alias("source_order"),
    ]


def record_rank() -> Column:
    """Sort key of competing records, as one value."""
    return F.struct(*record_order())


def dedupe_records(atoms: DataFrame, keys: Sequence[str] = EXACT_IDENTITY) -> DataFrame:
    """One record per identity: the first by :func:`record_rank`.

    Only the first of each identity leaves a task, so copies are not moved.
    """
    order = Window.partitionBy(*keys).orderBy(*record_order())
    return atoms.withColumn("__place", F.row_number().over(order)).where("__place = 1").drop("__place")


def duplicate_audit(atoms: DataFrame, keys: Sequence[str] = EXACT_IDENTITY) -> DataFrame:
    """Duplicate records per entry, and how many disagree in position.

    A repeat is compared with the record retained so far, in source order.
    """
    ranked = atoms.withColumn(
        "__rank", F.struct(record_rank().alias("rank"), "x", "y", "z")
    )
    seen = running_best(ranked, list(keys), "source_order", "__rank", "__kept")
    away = distance(
        (F.col("x"), F.col("y"), F.col("z")),
        tuple(F.col(f"__kept.{axis}") for axis in "xyz"),
    )
    repeat = F.col("__kept").isNotNull()
    return seen.groupBy("entry_id").agg(
        F.count_if(repeat).alias("duplicate_atom_record_count"),
        F.count_if(
            repeat & F.coalesce(away > vocab.DUPLICATE_POSITION_TOLERANCE, F.lit(False))
        ).alias("duplicate_atom_coordinate_conflict_count"),
    )


def conformer_means(source: DataFrame, residue: Sequence[str] = RESIDUE) -> DataFrame:
    """Mean valid occupancy of each named conformer of each residue."""
    return source.where(F.col("altloc") != "").groupBy(*residue, "altloc").agg(
        F.avg(F.when(F.col("occupancy_valid"), F.col("occupancy"))).alias("mean")
    )


def select_conformers(
    source: DataFrame, residue: Sequence[str] = RESIDUE
) -> DataFrame:
    """The conformer of every residue that has named ones.

    The highest mean wins; means within 1e-12 tie and the lowest label wins;
    without any valid occupancy the lowest label is a fallback choice. Labels
    are single characters, so the array per residue stays short.
    """
    options = conformer_means(source, residue).groupBy(*residue).agg(
        F.array_sort(F.collect_list(F.struct("altloc", "mean"))).alias("options")
    )
    ranked = options.selectExpr(
        "*",
        "array_max(transform(options, o -> o.mean)) AS best",
        "array_min(transform(options, o -> o.altloc)) AS lowest",
    )
    chosen = ranked.selectExpr(
        "*",
        f"coalesce(array_min(transform(filter(options, o -> best - o.mean <= "
        f"{vocab.CONFORMER_TIE!r}D), o -> o.altloc)), lowest) AS selected_altloc",
    )
    return chosen.selectExpr(
        *residue,
        "selected_altloc",
        "filter(options, o -> o.altloc = selected_altloc)[0].mean AS named_mean",
        "map_from_entries(options) AS altloc_options",
        "size(options) > 1 AS alternative_conformers_present",
        "best IS NULL AND size(options) > 1 AS altloc_selection_fallback",
    )


def residue_selections(source: DataFrame, residue: Sequence[str] = RESIDUE) -> DataFrame:
    """One row per residue: selected conformer, its mean, options, atom-site count."""
    base = source.groupBy(*residue).agg(
        F.avg(
            F.when((F.col("altloc") == "") & F.col("occupancy_valid"), F.col("occupancy"))
        ).alias("blank_mean"),
        F.count_distinct(
            F.when(F.col("element_key") != "", F.struct("atom_name", "element_key"))
        ).alias("chemical_atom_site_count"),
        F.max("is_water").alias("is_water"),
    )
    joined = base.join(select_conformers(source, residue), list(residue), "left")
    return joined.select(
        *residue,
        "is_water",
        F.coalesce("selected_altloc", F.lit("")).alias("selected_altloc"),
        F.when(F.col("selected_altloc").isNull(), F.col("blank_mean"))
        .otherwise(F.col("named_mean"))
        .alias("selected_conformer_mean_occupancy"),
        "altloc_options",
        F.coalesce("alternative_conformers_present", F.lit(False)).alias(
            "alternative_conformers_present"
        ),
        F.coalesce("altloc_selection_fallback", F.lit(False)).alias(
            "altloc_selection_fallback"
        ),
        "chemical_atom_site_count",
    )


def options_text(options: str = "altloc_options") -> Column:
    """Conformer options as ``A:0.6|B:NA`` for text output."""
    return F.array_join(
        F.transform(
            F.array_sort(F.map_entries(options)),
            lambda e: F.concat(
                e["key"], F.lit(":"),
                F.coalesce(
                    F.regexp_replace(F.format_string("%.6f", e["value"]), r"\.?0+$", ""),
                    F.lit("NA"),
                ),
            ),
        ),
        "|",
    )


def with_selected_altloc(source: DataFrame, residue: Sequence[str] = RESIDUE) -> DataFrame:
    """Add the ``selected_altloc`` of :func:`residue_selections` to every record.

    Runs inside residues, so records dealt by residue stay where they are.
    """
    label, whole = Window.partitionBy(*residue, "altloc"), Window.partitionBy(*residue)
    named = F.col("altloc") != ""
    mean = F.avg(F.when(F.col("occupancy_valid"), F.col("occupancy"))).over(label)
    top = F.max("__mean").over(whole)
    close = F.col("__top") - F.col("__mean") <= F.lit(vocab.CONFORMER_TIE)
    return (
        source.withColumn("__label_mean", mean)
        .withColumn("__mean", F.when(named, F.col("__label_mean")))
        .withColumn("__top", top)
        .withColumn("selected_altloc", F.coalesce(
            F.min(F.when(close, F.col("altloc"))).over(whole),
            F.min(F.when(named, F.col("altloc"))).over(whole), F.lit("")))
        .drop("__label_mean", "__mean", "__top")
    )


def contact_atoms(
    source: DataFrame, selections: DataFrame | None = None, residue: Sequence[str] = RESIDUE
) -> DataFrame:
    """Atoms of the selected conformers, one per residue and atom name.

    A named record of the selected conformer supersedes a blank one; what
    remains is settled by :func:`record_rank`. ``extra_records`` counts the
    records each atom superseded. Without ``selections`` the conformers are
    selected here, in the same pass over the records.
    """
    if selections is None:
        chosen = with_selected_altloc(source, residue)
    else:
        chosen = source.join(selections.select(*residue, "selected_altloc"), list(residue))
    eligible = chosen.where((F.col("altloc") == "") | (F.col("altloc") == F.col("selected_altloc")))
    atom = Window.partitionBy(*residue, "atom_name")
    placed = eligible.withColumns({
        "__place": F.row_number().over(atom.orderBy(F.col("altloc") == "", *record_order())),
        "extra_records": F.count(F.lit(1)).over(atom) - 1,
    })
    return placed.where("__place = 1").select(*source.columns, "extra_records")


def overfull_sites(source: DataFrame, site: Sequence[str] = CHEMICAL_SITE) -> DataFrame:
    """Chemical sites whose alternates sum above one, with the excess.

    ``judged`` is false where an alternate has no usable occupancy: the sum is
    unknown there, not sound. Sums run in decimals, so their order is free.
    """
    summed = source.groupBy(*site).agg(
        F.count(F.lit(1)).alias("alternates"),
        F.bool_and("occupancy_valid").alias("judged"),
        F.sum(
            F.when(F.col("occupancy_valid"), F.col("occupancy").cast("decimal(18,6)"))
        ).alias("total"),
        F.max("is_hydrogen").alias("is_hydrogen"),
    )
    over = F.col("judged") & (F.col("alternates") > 1) & (F.col("total") > 1)
    return summed.select(
        *site, "judged", "is_hydrogen",
        F.when(F.col("judged"), F.coalesce(over, F.lit(False))).alias("overfull"),
        F.when(over, F.col("total") - 1).alias("excess"),
    )


def entry_counts(records: DataFrame, source: DataFrame) -> DataFrame:
    """Record and occupancy counts of each entry.

    Occupancy defects are counted before duplicates collapse, so a valid twin
    cannot hide an invalid record; everything else counts collapsed atoms.
    """
    raw = records.groupBy("entry_id").agg(
        F.count_if(F.col("occupancy_status") == "missing").alias("missing_occupancy_count"),
        F.count_if(
            ~F.col("occupancy_valid") & (F.col("occupancy_status") != "missing")
        ).alias("invalid_occupancy_count"),
        F.count_if(~F.col("occupancy_valid") & ~F.col("is_hydrogen")).alias("unreadable_count"),
    )
    heavy = F.col("occupancy_valid") & ~F.col("is_hydrogen")
    placed = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
    kept = source.groupBy("entry_id").agg(
        F.count_if(F.col("occupancy_valid") & (F.col("occupancy") == 0)).alias(
            "zero_occupancy_atom_count"
        ),
        F.coalesce(
            F.sum(F.when(heavy, F.col("occupancy").cast("decimal(18,6)"))),
            F.lit(0).cast("decimal(18,6)"),
        ).alias("weighted_sum"),
        F.count_if(F.col("element_status") != "valid").alias("unknown_element_atom_count"),
        F.count_if(~placed).alias("non_finite_coordinate_atom_count"),
    )
    overfull = overfull_sites(source).where("overfull").groupBy("entry_id").agg(
        F.count(F.lit(1)).alias("overfull_occupancy_site_count"),
        F.sum("excess").alias("overfull_occupancy_excess"),
        F.sum(F.when(~F.col("is_hydrogen"), F.col("excess"))).alias("weighted_excess"),
    )
    joined = raw.join(kept, "entry_id").join(overfull, "entry_id", "left")
    excess = F.coalesce(F.col("weighted_excess").cast("double"), F.lit(0.0))
    total = F.col("weighted_sum").cast("double")
    too_full = (excess > 0) & (
        (total <= 0) | (excess > total * vocab.OVERFULL_NI_FRACTION)
    )
    failed = (F.col("unreadable_count") > 0) | too_full
    return joined.select(
        "entry_id", "missing_occupancy_count", "invalid_occupancy_count",
        "zero_occupancy_atom_count", "unknown_element_atom_count",
        "non_finite_coordinate_atom_count",
        F.coalesce("overfull_occupancy_site_count", F.lit(0)).alias(
            "overfull_occupancy_site_count"
        ),
        F.coalesce(F.col("overfull_occupancy_excess").cast("double"), F.lit(0.0)).alias(
            "overfull_occupancy_excess"
        ),
        failed.alias("occupancy_validation_failed"),
        F.when(~failed & (F.col("unknown_element_atom_count") == 0), total).alias(
            "deposited_occupancy_weighted_atom_count"
        ),
    )


def warning_counts(records: DataFrame) -> DataFrame:
    """Per entry, what :func:`structure_warnings` tells of its first-model records.

    The same numbers as :func:`duplicate_audit`, :func:`entry_counts`, the
    ``extra_records`` of :func:`contact_atoms` and the fallbacks of
    :func:`residue_selections`. Records are dealt once by residue; identities,
    sites, atoms and residues are settled where they are, and only sums leave.
    """
    needed = ("source_order", "occupancy", "occupancy_valid", "element_status", "x", "y", "z")
    dealt = records.select(*EXACT_IDENTITY, *needed).repartition(*RESIDUE)
    identity = Window.partitionBy(*EXACT_IDENTITY)
    earlier = identity.orderBy("source_order").rowsBetween(Window.unboundedPreceding, -1)
    place = (F.col("x"), F.col("y"), F.col("z"))
    seen = dealt.withColumn(
        "__kept", F.min(F.struct(record_rank().alias("rank"), "x", "y", "z")).over(earlier))
    away = distance(place, tuple(F.col(f"__kept.{axis}") for axis in "xyz"))
    source = seen.withColumn(
        "__moved", F.col("__kept").isNotNull() & (away > vocab.DUPLICATE_POSITION_TOLERANCE)
    ).withColumns({
        "__repeats": F.count(F.lit(1)).over(identity) - 1,
        "__conflicts": F.count_if("__moved").over(identity),
        "__place": F.row_number().over(identity.orderBy(*record_order())),
    }).where("__place = 1")
    chosen = with_selected_altloc(source)
    valid, named = F.col("occupancy_valid"), F.col("altloc") != ""
    label = F.when(named, F.col("altloc"))
    by_site = chosen.groupBy(*CHEMICAL_SITE).agg(
        F.sum("__repeats").alias("repeats"),
        F.sum("__conflicts").alias("conflicts"),
        F.count_if(~named | (F.col("altloc") == F.col("selected_altloc"))).alias("eligible"),
        F.count_if(F.col("element_status") != "valid").alias("unknown"),
        F.count_if(F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull()).alias("unplaced"),
        F.count_if(valid & (F.col("occupancy") == 0)).alias("zero"),
        F.coalesce(
            F.bool_and("occupancy_valid") & (F.count(F.lit(1)) > 1)
            & (F.sum(F.when(valid, F.col("occupancy").cast("decimal(18,6)"))) > 1),
            F.lit(False)).cast("int").alias("overfull"),
        F.count_if(named & valid).alias("usable"),
        F.min(label).alias("lowest"), F.max(label).alias("highest"),
    )
    sums = ("repeats", "conflicts", "unknown", "unplaced", "zero", "overfull")

    def summed(*more: str) -> list[Column]:
        return [F.sum(c).alias(c) for c in (*sums, *more)]

    spread = [F.min("lowest").alias("lowest"), F.max("highest").alias("highest")]
    by_atom = by_site.groupBy(*RESIDUE, "atom_name").agg(*summed("eligible", "usable"), *spread)
    by_residue = by_atom.withColumn("extra", F.greatest(F.col("eligible") - 1, F.lit(0))).groupBy(
        *RESIDUE).agg(*summed("extra", "usable"), *spread)
    fallback = (F.col("usable") == 0) & (F.col("lowest") < F.col("highest"))
    return by_residue.groupBy("entry_id").agg(
        *summed("extra"), F.count_if(fallback).alias("fallback_count")
    ).withColumnsRenamed({
        "repeats": "duplicate_atom_record_count",
        "conflicts": "duplicate_atom_coordinate_conflict_count",
        "unknown": "unknown_element_atom_count",
        "unplaced": "non_finite_coordinate_atom_count",
        "zero": "zero_occupancy_atom_count",
        "overfull": "overfull_occupancy_site_count",
        "extra": "malformed_duplicate_atom_name_count",
    })


def structure_warnings(counts: DataFrame) -> DataFrame:
    """Add ``warning_codes`` in their published order.

    ``counts`` joins the entry counts, duplicate audit, model counts and the
    columns ``malformed_duplicate_atom_name_count``, ``fallback_count``,
    ``defaulted_count``, ``mapping_failed`` and ``identifiers_packed``.
    """
    has = lambda name: F.coalesce(F.col(name), F.lit(0)) > 0
    return counts.withColumn(
        "warning_codes",
        labels(
            [
                (F.col("input_model_count") > 1, "multi_model_structure"),
                (has("duplicate_atom_record_count"), "duplicate_atom_records"),
                (has("duplicate_atom_coordinate_conflict_count"),
                 "duplicate_atom_coordinate_conflict"),
                (has("malformed_duplicate_atom_name_count"), "malformed_duplicate_atom_names"),
                (has("fallback_count"), "altloc_selection_fallback"),
                (has("unknown_element_atom_count"), "unknown_elements"),
                (has("non_finite_coordinate_atom_count"), "non_finite_coordinates"),
                (has("zero_occupancy_atom_count"), "zero_occupancy_atoms"),
                (has("overfull_occupancy_site_count"), "overfull_alternate_occupancy"),
                (has("defaulted_count"), "occupancy_dictionary_default_applied"),
                (F.coalesce("mapping_failed", F.lit(False)), "raw_occupancy_mapping_failed"),
                (F.coalesce("identifiers_packed", F.lit(False)),
                 "legacy_pdb_identifiers_packed"),
            ]
        ),
    )


def entry_median_b(atoms: DataFrame) -> DataFrame:
    """Median B factor of the modelled, non-water, non-hydrogen atoms of each entry."""
    absent = F.col("occupancy_valid") & F.coalesce(F.col("occupancy") == 0, F.lit(False))
    kept = atoms.where(~F.col("is_water") & ~F.col("is_hydrogen") & ~absent)
    medians = exact_median(kept, ["entry_id"], "b_iso", "median_b")
    return with_rounded(medians, {"entry_nonwater_median_b_iso": ("median_b", 3)}).select(
        "entry_id", "entry_nonwater_median_b_iso"
    )


def weighted_atom_count(deposited: Column, ncs_operations: Column) -> Column:
    """The deposited count times one plus the strict-NCS copies."""
    return deposited * (1 + F.coalesce(ncs_operations, F.lit(0)))


def early_outcome(entries: DataFrame, site_limit: int = vocab.MAX_METAL_SITES) -> DataFrame:
    """Entries that finish before any contact or density work, with their outcome.

    ``entries`` holds ``entry_id, n_metals, unknown_element_atom_count``.
    """
    over = F.col("n_metals") > site_limit
    none = F.col("n_metals") == 0
    unknown = none & (F.col("unknown_element_atom_count") > 0)
    status = F.when(over, F.lit("ok")).when(unknown, F.lit("partial")).when(none, F.lit("ok"))
    return entries.withColumn("status", status).where(F.col("status").isNotNull()).select(
        "entry_id",
        "status",
        "n_metals",
        F.when(~unknown, F.lit(0)).alias("n_bonds"),
        F.when(~unknown, F.lit(0)).alias("n_candidates"),
        F.coalesce(
            F.when(over, F.array(F.lit("metal_site_limit_exceeded"))),
            F.when(unknown, F.array(F.lit("metal_presence_indeterminate"))),
            F.array().cast("array<string>"),
        ).alias("reason_codes"),
        F.when(
            unknown,
            F.concat(
                F.lit("cannot establish metal absence: "),
                F.col("unknown_element_atom_count").cast("string"),
                F.lit(" atom(s) have missing or invalid element symbols"),
            ),
        ).otherwise(F.lit("")).alias("status_detail"),
        (none & ~unknown).alias("no_metals"),
        over.alias("metal_site_limit_exceeded"),
    )


def analyzable(atoms: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Atoms of the entries that did not finish early: the gate before heavy joins."""
    return atoms.join(outcomes.select("entry_id"), "entry_id", "left_anti")


def metal_counts(atoms: DataFrame) -> DataFrame:
    """Selected metals, and those excluded for zero occupancy, per entry."""
    metal = F.coalesce(F.col("element").isin(*vocab.METALS), F.lit(False))
    absent = F.col("occupancy_valid") & F.coalesce(F.col("occupancy") == 0, F.lit(False))
    return atoms.groupBy("entry_id").agg(
        F.count_if(metal & ~absent).alias("n_metals"),
        F.count_if(metal & absent).alias("zero_occupancy_metal_count"),
    )
