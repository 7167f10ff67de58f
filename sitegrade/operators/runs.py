"""Entry outcomes rolled up to run reports, and the review queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import as_col, first_label, is_subset, labels, text_array

#: Entry flags that a run counts.
FLAGS = ("retryable", "no_metals", "metal_site_limit_exceeded")


# ---- outcome rules -------------------------------------------------------------
def entry_status(reason_codes: str | Column) -> Column:
    """A finished entry is ok without reasons and partial with any."""
    return F.when(F.size(as_col(reason_codes)) == 0, F.lit("ok")).otherwise(F.lit("partial"))


def is_retryable(status: str | Column, reason_codes: str | Column) -> Column:
    """Whether an ordinary resume should run an entry again."""
    s = as_col(status)
    stage_failed = F.arrays_overlap(
        as_col(reason_codes), text_array(vocab.RETRYABLE_PARTIAL_CODES)
    )
    return (
        F.when(s == "ok", F.lit(False))
        .when(s.isin("skip", "error"), F.lit(True))
        .otherwise(F.coalesce(stage_failed, F.lit(False)))
    )


def is_terminal(status: str | Column, retryable: str | Column, reason_codes: str | Column) -> Column:
    """Whether a stored row protects its entry from another run.

    A partial protects only when it says it is not retryable and cites no code
    this build does not know. ``retryable`` may be null.
    """
    final = F.coalesce(~as_col(retryable), F.lit(False))
    known = is_subset(as_col(reason_codes), vocab.REASON_CODES)
    return (as_col(status) == "ok") | ((as_col(status) == "partial") & final & known)


def error_reason(error_class: str | Column) -> Column:
    """Reason code of an error: deterministic classes recur on identical inputs."""
    return F.when(
        as_col(error_class).isin(*vocab.DETERMINISTIC_ERRORS),
        F.lit("deterministic_processing_error"),
    ).otherwise(F.lit("unexpected_processing_error"))


def shortened(text: Column, limit: int) -> Column:
    """Text cut to ``limit`` characters, ending in a count of what was left out."""
    trimmed = F.trim(text)
    size = F.length(trimmed)

    def note(omitted: Column) -> Column:
        return F.concat(F.lit("... ["), omitted.cast("string"), F.lit(" more characters]"))

    keep = F.greatest(F.lit(0), F.lit(limit) - F.length(note(size - limit)))
    keep = F.greatest(F.lit(0), F.lit(limit) - F.length(note(size - keep)))
    shown = F.when(keep > 0, F.concat(F.substring(trimmed, F.lit(1), keep), note(size - keep))).otherwise(
        trimmed
    )
    return F.when(size <= limit, trimmed).otherwise(F.substring(shown, 1, limit))


def joined_detail(existing: Column, added: Column, limit: int = vocab.STATUS_DETAIL_CHARS) -> Column:
    """Two details within one cap; when they do not fit, each gets half."""
    both = F.concat(existing, F.lit("; "), added)
    half = (limit - 2) // 2
    return (
        F.when(existing == "", shortened(added, limit))
        .when(added == "", existing)
        .when(F.length(both) <= limit, both)
        .otherwise(F.concat(shortened(existing, half), F.lit("; "), shortened(added, half)))
    )


# ---- roll-ups ------------------------------------------------------------------
def status_counts(manifest: DataFrame) -> DataFrame:
    """Entries per status."""
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("count"))


def manifest_provenance(manifest: DataFrame) -> DataFrame:
    """One row: entry counts and whether one configuration made every row.

    The lowest and highest id decide that, so no set of ids is ever gathered.
    """
    config = F.trim(F.coalesce("analysis_config_id", F.lit("")))
    return manifest.agg(
        F.count(F.lit(1)).alias("source_entry_count"),
        F.count_if("no_metals").alias("no_metals_entry_count"),
        F.count_if("metal_site_limit_exceeded").alias("metal_site_limit_exceeded_entry_count"),
        F.count_if(F.col("n_metals") > 0).alias("metal_bearing_entry_count"),
        F.min(config).alias("analysis_config_id"),
        F.coalesce((F.min(config) == F.max(config)) & (F.min(config) != ""), F.lit(False)).alias(
            "single_configuration"
        ),
    )


def software_versions(manifest: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-blank versions per software column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("software"), F.col(c).alias("version")) for c in columns])
    return manifest.select(F.inline(pairs)).where(F.coalesce("version", F.lit("")) != "").distinct()


def ids_match(rows: DataFrame, column: str, current: str) -> DataFrame:
    """One row: whether every recorded id equals the current one (vacuously true)."""
    value = F.trim(F.coalesce(column, F.lit("")))
    return rows.agg(
        F.coalesce(F.bool_and(value == current), F.lit(True)).alias("compatible"),
        F.count_if(value == "").alias("blank_rows"),
        F.count(F.lit(1)).alias("rows"),
    )


def batch_tally(manifest: DataFrame) -> DataFrame:
    """One row of batch totals and the number of entries a retry could still add."""
    failed = F.col("status") == "error"
    deterministic = (F.size("reason_codes") > 0) & F.forall(
        "reason_codes", lambda c: c == "deterministic_processing_error"
    )
    retry = (F.col("status") == "partial") & F.col("retryable")
    tally = manifest.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in vocab.ENTRY_STATUSES],
        F.count_if("no_metals").alias("no_metals"),
        F.count_if("metal_site_limit_exceeded").alias("metal_site_limit_exceeded"),
        F.count_if(retry).alias("retryable_partials"),
        F.count_if(failed & deterministic).alias("terminal_errors"),
        F.count_if(failed & ~deterministic).alias("recoverable_errors"),
    )
    return tally.withColumn(
        "recoverable_incompleteness",
        F.col("skip") + F.col("retryable_partials") + F.col("recoverable_errors"),
    )


def code_histogram(manifest: DataFrame) -> DataFrame:
    """Entries per status, reason, warning and map scope: ``kind, name, count``."""
    tagged = F.concat(
        F.array(F.struct(F.lit("status").alias("kind"), F.col("status").alias("name"))),
        F.transform("reason_codes", lambda c: F.struct(F.lit("reason").alias("kind"), c.alias("name"))),
        F.transform("warning_codes", lambda c: F.struct(F.lit("warning").alias("kind"), c.alias("name"))),
        F.array(F.struct(F.lit("scope").alias("kind"), F.col("map_scope").alias("name"))),
    )
    return (
        manifest.select(F.inline(tagged))
        .where(F.coalesce("name", F.lit("")) != "")
        .groupBy("kind", "name")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("kind", F.desc("count"), "name")
    )


def run_totals(manifest: DataFrame, elapsed_s: float) -> DataFrame:
    """One row: entries, flags, summed runtime, and entries per minute."""
    rate = F.count(F.lit(1)) * 60.0 / elapsed_s if elapsed_s > 0 else F.lit(0.0)
    return manifest.agg(
        F.count(F.lit(1)).alias("entries"),
        *[F.count_if(f).alias(f"{f}_entries") for f in FLAGS],
        F.sum("runtime_s").alias("runtime_s"),
        F.lit(rate).alias("entries_per_minute") if isinstance(rate, float) else rate.alias("entries_per_minute"),
    )


def stage_timing(diagnostics: DataFrame) -> DataFrame:
    """Entries, total, mean, maximum and slowest entry of each stage."""
    timed = diagnostics.select("entry_id", F.explode("timings").alias("stage", "seconds"))
    return timed.groupBy("stage").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum("seconds").alias("total_s"),
        F.avg("seconds").alias("mean_s"),
        F.max("seconds").alias("max_s"),
        F.min_by("entry_id", F.struct(-F.col("seconds"), F.col("entry_id"))).alias("max_entry"),
    )


def stage_columns(diagnostics: DataFrame, most: int = 1000) -> list[str]:
    """The stages present, known ones in run order, then the rest by name.

    Stages become columns, so more than ``most`` of them are refused.
    """
    names = diagnostics.select(F.explode(F.map_keys("timings"))).distinct()
    present = {row[0] for row in names.limit(most + 1).collect()}
    if len(present) > most:
        raise ValueError(f"more than {most} stage names")
    known = [s for s in vocab.STAGE_ORDER if s in present]
    return [*known, *sorted(present - set(known))]


def diagnostics_table(diagnostics: DataFrame, stages: Sequence[str]) -> DataFrame:
    """One row per entry with a column per stage, sorted by entry."""
    rest = [c for c in diagnostics.columns if c != "timings"]
    return diagnostics.select(
        *rest, *[F.try_element_at("timings", F.lit(s)).alias(s) for s in stages]
    ).orderBy(F.lower("entry_id"))


def policy_exclusions(manifest: DataFrame) -> DataFrame:
    """Entries above the site limit, largest first."""
    return manifest.where("metal_site_limit_exceeded").select("entry_id", "n_metals").orderBy(
        F.desc("n_metals"), F.lower("entry_id")
    )


def exceptions(manifest: DataFrame) -> DataFrame:
    """Entries that did not finish ok, told apart by whether the reason is routine.

    A terminal partial whose only reason is a missing reference is routine.
    """
    routine = (
        (F.col("status") == "partial")
        & ~F.col("retryable")
        & (F.array_sort(F.array_distinct("reason_codes"))
           == F.array(F.lit("missing_first_sphere_reference")))
    )
    return manifest.where(F.col("status") != "ok").select(
        "entry_id", "status", "retryable",
        F.when(F.size("reason_codes") == 0, F.lit("-"))
        .otherwise(F.array_join("reason_codes", "|"))
        .alias("reasons"),
        routine.alias("routine"),
    ).orderBy(F.lower("entry_id"))


def slowest(manifest: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` longest-running entries; equal runtimes in entry order."""
    return manifest.orderBy(F.desc("runtime_s"), "entry_id").limit(n)


def carry_prior_counts(
    manifest: DataFrame, prior: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Counts of a stage that did not run this time, taken from the prior manifest."""
    old = prior.select(
        F.lower("entry_id").alias("__entry"), *[F.col(c).alias(f"__{c}") for c in columns]
    )
    joined = manifest.join(old, F.lower("entry_id") == F.col("__entry"), "left")
    return joined.withColumns({c: F.col(f"__{c}") for c in columns}).select(*manifest.columns)


# ---- review queue --------------------------------------------------------------
CONTEXT_FLAGS = (
    ("heavy_additive_phasing_metal", "heavy_additive_phasing_metal"),
    ("ni_co_like_metal", "ni_co_like_metal"),
    ("sulfate", "sulfate"),
    ("cacodylate", "cacodylate"),
    ("acetate", "acetate"),
)


def review_queue(scores: DataFrame, summaries: DataFrame) -> DataFrame:
    """REVIEW and SUSPECT sites with their entry's condition context.

    A question about metals stays null while no condition data is available.
    """
    queued = scores.where(F.col("site_level").isin("REVIEW", "SUSPECT"))
    context = summaries.withColumn("__entry", F.lower(F.trim("entry_id"))).drop("entry_id")
    joined = queued.join(context, F.lower(F.trim("entry_id")) == F.col("__entry"), "left")
    modeled = F.upper(F.trim(F.coalesce("metal_element", F.lit(""))))
    none = F.array().cast("array<string>")
    metals = F.coalesce("metals", none)
    available = F.coalesce(F.col("data_status") == "available", F.lit(False))
    own = F.when(available & (modeled != ""), F.array_contains(metals, modeled))
    other = F.when(
        available,
        F.arrays_overlap(
            F.array_except(metals, F.array(modeled)), text_array(vocab.PROMISCUOUS_METALS)
        ),
    )
    marked = joined.withColumns(
        {"contains_modeled_metal": own, "contains_different_promiscuous_metal": other}
    )
    return marked.withColumn(
        "context_flags",
        labels(
            [
                (F.col("contains_modeled_metal"), "modeled_metal"),
                (F.col("contains_different_promiscuous_metal"),
                 "different_promiscuous_transition_metal"),
                *[(F.coalesce(F.col(c), F.lit(False)), name) for c, name in CONTEXT_FLAGS],
            ]
        ),
    ).drop("__entry")


# ---- incremental runs ----------------------------------------------------------
def done_entries(
    manifest: DataFrame, *, bonds_required: bool = False, bond_tables_present: bool = True,
    retry_partials: bool = False,
) -> DataFrame:
    """Entries a resumed run may skip."""
    keep = is_terminal("status", "retryable", "reason_codes")
    if retry_partials:
        keep = keep & (F.col("status") == "ok")
    if bonds_required:
        counted = F.col("n_bonds").isNotNull() & F.col("n_candidates").isNotNull()
        exempt = F.array_contains("reason_codes", "metal_presence_indeterminate")
        keep = keep & F.lit(bond_tables_present) & (exempt | counted)
    return manifest.where(keep).select(F.lower(F.trim("entry_id")).alias("entry_id")).distinct()


def pending_entries(ids: DataFrame, done: DataFrame, cap: int | None = None) -> DataFrame:
    """Ids still to run; a cap applies after the finished ones are taken out."""
    left = ids.join(
        done.withColumnRenamed("entry_id", "__done"),
        F.lower("entry_id") == F.col("__done"), "left_anti",
    )
    return left if cap is None else left.orderBy("entry_id").limit(cap)


def replace_by_key(
    target: DataFrame, staged: DataFrame, replaced: DataFrame, key: str = "entry_id"
) -> DataFrame:
    """``target`` with the rows of ``replaced`` keys taken from ``staged`` instead."""
    ids = replaced.select(F.lower(key).alias("__key")).distinct()
    on = lambda df: F.lower(df[key]) == F.col("__key")
    kept = target.join(ids, on(target), "left_anti")
    fresh = staged.join(ids, on(staged), "left_semi")
    return kept.unionByName(fresh)


def replaceable(results: DataFrame) -> DataFrame:
    """Retried entries whose outcome may replace the stored one."""
    final = (F.col("status") == "ok") | ((F.col("status") == "partial") & ~F.col("retryable"))
    return results.where(final).select("entry_id")


def owned_rows(rows: DataFrame, terminal: DataFrame, key: str = "entry_id") -> DataFrame:
    """Rows that belong to protected entries."""
    ids = terminal.select(F.lower(key).alias("__key")).distinct()
    return rows.join(ids, F.lower(rows[key]) == F.col("__key"), "left_semi")


def reconcile_counts(
    manifest: DataFrame, rows: DataFrame, count_column: str, key: str = "entry_id",
    *, blank_is_zero: bool = True,
) -> DataFrame:
    """Protected entries whose stored row count disagrees with their manifest row.

    ok needs equality, partial at most the count, an excluded entry none.
    """
    actual = rows.groupBy(key).agg(F.count(F.lit(1)).alias("actual"))
    expected = F.coalesce(F.col(count_column), F.lit(0) if blank_is_zero else F.lit(None))
    excluded = F.coalesce(F.col("metal_site_limit_exceeded"), F.lit(False))
    joined = (
        manifest.where(is_terminal("status", "retryable", "reason_codes"))
        .join(actual, key, "left")
        .withColumns(
            {
                "actual": F.coalesce("actual", F.lit(0)),
                "expected": F.when(excluded, F.lit(0)).otherwise(expected).cast("long"),
            }
        )
    )
    wrong = F.when(F.col("status") == "ok", F.col("actual") != F.col("expected")).otherwise(
        F.col("actual") > F.col("expected")
    )
    return joined.where(wrong).select(key, "status", "expected", "actual")


def reconcile_tables(
    manifest: DataFrame, tables: dict[str, tuple[DataFrame, str]], key: str = "entry_id",
) -> DataFrame:
    """Every disagreement of protected manifest rows with the stored tables of a run.

    ``tables`` maps a name to its rows and the manifest column that counts them.
    All rows are tagged and counted in one aggregate, then met once by the
    manifest. An ok entry needs the exact number (``equal``), a partial one at
    most that many (``at_most``), an excluded one none (``none``); a blank number
    stands for zero. Rows of entries without any manifest row are ``unknown_entry``.
    """
    tagged = None
    for name, (rows, _) in tables.items():
        part = rows.select(F.lit(name).alias("table"), F.lower(F.trim(key)).alias("__key"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counted = tagged.groupBy("table", "__key").agg(F.count(F.lit(1)).alias("actual"))
    told = manifest.select(
        F.lower(F.trim(key)).alias("__key"), "status",
        is_terminal("status", "retryable", "reason_codes").alias("protected"),
        F.coalesce(F.col("metal_site_limit_exceeded"), F.lit(False)).alias("excluded"),
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("table"), F.coalesce(F.col(count).cast("long"), F.lit(0)).alias("stated"))
            for name, (_, count) in tables.items()])).alias("t"),
    ).select("__key", "status", "protected", "excluded", "t.*")
    joined = told.join(counted, ["table", "__key"], "full_outer").withColumn(
        "actual", F.coalesce("actual", F.lit(0)))
    ok = F.col("status") == "ok"
    rule = first_label(
        [
            (F.col("protected").isNull(), "unknown_entry"),
            (~F.col("protected"), ""),
            (F.col("excluded") & (F.col("actual") > 0), "none"),
            (F.col("excluded"), ""),
            (ok & (F.col("actual") != F.col("stated")), "equal"),
            (~ok & (F.col("actual") > F.col("stated")), "at_most"),
        ], "")
    return joined.withColumn("rule", rule).where("rule <> ''").select(
        F.col("table"), F.col("__key").alias(key), "status",
        F.when(F.col("excluded"), F.lit(0)).otherwise(F.col("stated")).cast("long").alias("stated"),
        "actual", "rule")


def manifest_conflicts(manifest: DataFrame) -> DataFrame:
    """Rows whose flags contradict one another, with the rule they break."""
    ok = F.col("status") == "ok"
    excluded = F.col("metal_site_limit_exceeded")
    cited = F.array_contains("reason_codes", "metal_site_limit_exceeded")
    rule = first_label(
        [
            (excluded != cited, "flag_disagrees_with_reason"),
            (excluded & (F.col("no_metals") | ~ok | (F.col("n_metals") <= vocab.MAX_METAL_SITES)),
             "invalid_exclusion"),
            (F.col("no_metals") & (~ok | (F.col("n_metals") != 0)), "invalid_no_metals"),
        ],
        None,
    )
    return manifest.withColumn("rule", rule).where(F.col("rule").isNotNull()).select(
        "entry_id", "rule"
    )


def header_difference(found: Sequence[str], expected: Sequence[str]) -> str:
    """How a stored header departs from the expected one; blank when it does not."""
    missing = [c for c in expected if c not in found]
    extra = [c for c in found if c not in expected]
    parts = []
    if missing:
        parts.append("missing " + ", ".join(missing))
    if extra:
        parts.append("unexpected " + ", ".join(extra))
    if not parts and list(found) != list(expected):
        parts.append("the same columns in a different order")
    return "; ".join(parts)
