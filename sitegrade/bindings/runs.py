"""Run-report, review and incremental queries; customers are entries."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.bindings import contacts as bc
from sitegrade.bindings.common import Query, derived, fixed, fixed_sql, plain, table
from sitegrade.bindings.inventory import source_atoms
from sitegrade.functions.clean import pipe_split
from sitegrade.operators import runs
from sitegrade.operators.lookup import literature
from sitegrade.plans import run
from sitegrade.session import cut_lineage, ensure_checkpoint_dir
from sitegrade.streaming.store import EntryStore

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MANIFEST = """
SELECT CAST(c_custkey AS STRING) AS entry_id, c_custkey AS k,
  CASE WHEN c_custkey % 10 < 6 THEN 'ok' WHEN c_custkey % 10 < 8 THEN 'partial'
       WHEN c_custkey % 10 = 8 THEN 'skip' ELSE 'error' END AS status,
  CASE WHEN c_custkey % 10 < 6 THEN FALSE WHEN c_custkey % 10 < 8 THEN c_custkey % 3 = 0 ELSE TRUE END AS retryable,
  c_custkey % 7 = 0 AS no_metals,
  c_custkey % 23 = 0 AS metal_site_limit_exceeded,
  CASE WHEN c_custkey % 7 = 0 THEN 0 WHEN c_custkey % 23 = 0 THEN 120 ELSE c_custkey % 9 END AS n_metals,
  CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 13 END AS n_bonds,
  CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 17 END AS n_candidates,
  abs(c_acctbal) AS runtime_s,
  CASE WHEN c_custkey % 10 < 6 THEN CASE WHEN c_custkey % 23 = 0 THEN 'metal_site_limit_exceeded' ELSE '' END
       WHEN c_custkey % 10 < 8 THEN CASE c_custkey % 4 WHEN 0 THEN 'missing_first_sphere_reference'
            WHEN 1 THEN 'bond_stage_failure|invalid_occupancy' WHEN 2 THEN 'metal_presence_indeterminate' ELSE 'retired_code' END
       WHEN c_custkey % 10 = 8 THEN 'missing_input'
       WHEN c_custkey % 4 = 1 THEN 'deterministic_processing_error' ELSE 'unexpected_processing_error' END AS reason_text,
  CASE c_custkey % 5 WHEN 0 THEN 'zero_occupancy_atoms|unknown_elements' WHEN 1 THEN 'unknown_elements' ELSE '' END AS warning_text,
  CASE c_custkey % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'model-envelope' ELSE '' END AS map_scope,
  'config-a' AS analysis_config_id, c_mktsegment AS engine_version
FROM {customer}
"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(spark, sf_dir, MANIFEST)
    return rows.withColumns(
        {"reason_codes": pipe_split("reason_text"), "warning_codes": pipe_split("warning_text")}
    ).drop("reason_text", "warning_text")


_KNOWN = ", ".join(f"'{c}'" for c in vocab.REASON_CODES)
_M = f"""m AS (SELECT *, list_filter(string_split(reason_text, '|'), lambda c: c <> '') AS rs,
  list_filter(string_split(warning_text, '|'), lambda c: c <> '') AS ws FROM ({plain(MANIFEST)})),
t AS (SELECT *, status = 'ok' OR (status = 'partial' AND NOT retryable AND list_has_all([{_KNOWN}], rs)) AS terminal FROM m)"""


def _simple(name: str, query: Query, sql: str) -> None:
    QUERIES[name] = query
    ORACLES[name] = sql


def entry_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    return rows.select(
        "entry_id",
        runs.entry_status("reason_codes").alias("status_by_reasons"),
        runs.is_retryable("status", "reason_codes").alias("retry"),
        runs.is_terminal("status", "retryable", "reason_codes").alias("terminal"),
        runs.error_reason(F.when(F.col("k") % 2 == 0, "ValueError").otherwise("TypeError")).alias("error_reason"),
    )


_simple("entry_outcomes", entry_outcomes, f"""WITH {_M}
SELECT entry_id, CASE WHEN len(rs) = 0 THEN 'ok' ELSE 'partial' END AS status_by_reasons,
  CASE status WHEN 'ok' THEN FALSE WHEN 'skip' THEN TRUE WHEN 'error' THEN TRUE
    ELSE list_has_any(rs, ['ccp4_tool_timeout', 'bond_stage_failure']) END AS retry, terminal,
  CASE WHEN k % 2 = 0 THEN 'deterministic_processing_error' ELSE 'unexpected_processing_error' END AS error_reason
FROM t""")


def manifest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.manifest_provenance(manifest(spark, sf_dir))


_simple("manifest_rollup", manifest_rollup, f"""WITH {_M}
SELECT count(*) AS source_entry_count, count(*) FILTER (no_metals) AS no_metals_entry_count,
  count(*) FILTER (metal_site_limit_exceeded) AS metal_site_limit_exceeded_entry_count,
  count(*) FILTER (n_metals > 0) AS metal_bearing_entry_count, min(analysis_config_id) AS analysis_config_id,
  count(DISTINCT analysis_config_id) = 1 AS single_configuration FROM m""")


def software_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.software_versions(manifest(spark, sf_dir), ["engine_version", "analysis_config_id"])


_simple("software_versions", software_versions, f"""WITH {_M}
SELECT DISTINCT 'engine_version' AS software, engine_version AS version FROM m
UNION ALL SELECT DISTINCT 'analysis_config_id', analysis_config_id FROM m""")


def id_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.ids_match(manifest(spark, sf_dir), "engine_version", "BUILDING").select(
        "compatible", "blank_rows", "rows"
    )


_simple("id_compatibility", id_compatibility, f"""WITH {_M}
SELECT bool_and(engine_version = 'BUILDING') AS compatible, CAST(0 AS BIGINT) AS blank_rows, count(*) AS rows FROM m""")


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.status_counts(manifest(spark, sf_dir))


_simple("status_counts", status_counts, f"WITH {_M} SELECT status, count(*) AS count FROM m GROUP BY status")


def batch_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.batch_tally(manifest(spark, sf_dir))


_simple("batch_tally", batch_tally, f"""WITH {_M},
c AS (SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'partial') AS partial,
  count(*) FILTER (status = 'skip') AS skip, count(*) FILTER (status = 'error') AS error,
  count(*) FILTER (no_metals) AS no_metals, count(*) FILTER (metal_site_limit_exceeded) AS metal_site_limit_exceeded,
  count(*) FILTER (status = 'partial' AND retryable) AS retryable_partials,
  count(*) FILTER (status = 'error' AND reason_text = 'deterministic_processing_error') AS terminal_errors,
  count(*) FILTER (status = 'error' AND reason_text <> 'deterministic_processing_error') AS recoverable_errors FROM m)
SELECT *, skip + retryable_partials + recoverable_errors AS recoverable_incompleteness FROM c""")


def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.code_histogram(manifest(spark, sf_dir))


_simple("reason_histogram", reason_histogram, f"""WITH {_M},
x AS (SELECT 'status' AS kind, status AS name FROM m UNION ALL SELECT 'reason', unnest(rs) FROM m
  UNION ALL SELECT 'warning', unnest(ws) FROM m UNION ALL SELECT 'scope', map_scope FROM m)
SELECT kind, name, count(*) AS count FROM x WHERE name <> '' GROUP BY ALL""")


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = runs.run_totals(manifest(spark, sf_dir), 90.0)
    return totals.withColumns({c: fixed(c, 3) for c in ("runtime_s", "entries_per_minute")})


_simple("run_totals", run_totals, f"""WITH {_M}
SELECT count(*) AS entries, count(*) FILTER (retryable) AS retryable_entries, count(*) FILTER (no_metals) AS no_metals_entries,
  count(*) FILTER (metal_site_limit_exceeded) AS metal_site_limit_exceeded_entries,
  {fixed_sql("sum(runtime_s)", 3)} AS runtime_s, {fixed_sql("count(*) * 60e0 / 90e0", 3)} AS entries_per_minute FROM m""")


def _diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, the slowest event of each type as a stage time."""
    peaks = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.max("value").alias("seconds")
    )
    return peaks.groupBy(F.col("user_id").cast("string").alias("entry_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "seconds"))).alias("timings")
    )


def stage_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    timing = runs.stage_timing(_diagnostics(spark, sf_dir))
    return timing.withColumns({c: fixed(c, 4) for c in ("total_s", "mean_s", "max_s")})


_simple("stage_timing", stage_timing, f"""
WITH p AS (SELECT CAST(user_id AS VARCHAR) AS e, event_type AS stage, max(value) AS s FROM events GROUP BY ALL)
SELECT stage, count(*) AS entries, {fixed_sql("sum(s)", 4)} AS total_s, {fixed_sql("avg(s)", 4)} AS mean_s,
  {fixed_sql("max(s)", 4)} AS max_s, arg_min(e, (-s, e)) AS max_entry FROM p GROUP BY stage""")


def diagnostics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _diagnostics(spark, sf_dir)
    return runs.diagnostics_table(rows, runs.stage_columns(rows))


_simple("diagnostics_table", diagnostics_table, """
SELECT CAST(user_id AS VARCHAR) AS entry_id, max(value) FILTER (event_type = 'click') AS click,
  max(value) FILTER (event_type = 'error') AS error, max(value) FILTER (event_type = 'purchase') AS purchase,
  max(value) FILTER (event_type = 'signup') AS signup, max(value) FILTER (event_type = 'view') AS view
FROM events GROUP BY user_id""")


def slowest_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.slowest(manifest(spark, sf_dir)).select("entry_id", "status", "runtime_s", "n_metals")


_simple("slowest_top20", slowest_top20, f"""WITH {_M}
SELECT entry_id, status, runtime_s, CAST(n_metals AS BIGINT) AS n_metals FROM m ORDER BY runtime_s DESC, entry_id LIMIT 20""")


def policy_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.policy_exclusions(manifest(spark, sf_dir))


_simple("policy_exclusions", policy_exclusions, f"""WITH {_M}
SELECT entry_id, CAST(n_metals AS BIGINT) AS n_metals FROM m WHERE metal_site_limit_exceeded""")


def run_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.exceptions(manifest(spark, sf_dir))


_simple("run_exceptions", run_exceptions, f"""WITH {_M}
SELECT entry_id, status, retryable, CASE WHEN reason_text = '' THEN '-' ELSE reason_text END AS reasons,
  status = 'partial' AND NOT retryable AND reason_text = 'missing_first_sphere_reference' AS routine
FROM m WHERE status <> 'ok'""")


def _shortened_sql(text: str, limit: int) -> str:
    """SQL of a text cut to ``limit`` characters with a count of the rest."""
    size = f"length({text})"
    first = f"({limit} - 22 - length(CAST({size} - {limit} AS VARCHAR)))"
    keep = f"({limit} - 22 - length(CAST({size} - {first} AS VARCHAR)))"
    return (f"CASE WHEN {size} <= {limit} THEN {text} ELSE substring(substring({text}, 1, {keep}) "
            f"|| '... [' || ({size} - {keep}) || ' more characters]', 1, {limit}) END")


DETAILS_SQL = f"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE lang END AS first,
  text, trim(text, ' ') AS t FROM documents)
SELECT doc_id, CASE WHEN first = '' THEN {_shortened_sql('t', 300)}
  WHEN text = '' THEN first
  WHEN length(first) + 2 + length(text) <= 300 THEN first || '; ' || text
  ELSE {_shortened_sql('first', 149)} || '; ' || {_shortened_sql('t', 149)} END AS detail
FROM d"""


def status_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts as messages: what a bounded status detail keeps of two."""
    docs = table(spark, sf_dir, "documents")
    first = F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(F.col("lang"))
    return docs.select("doc_id", runs.joined_detail(first, F.col("text")).alias("detail"))


_simple("status_details", status_details, DETAILS_SQL)


def carried_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    prior = rows.where("k % 2 = 0").selectExpr("entry_id", "n_bonds + 100 AS n_bonds", "n_candidates")
    return runs.carry_prior_counts(rows, prior, ["n_bonds", "n_candidates"]).selectExpr(
        "entry_id", "CAST(n_bonds AS BIGINT) AS n_bonds", "CAST(n_candidates AS BIGINT) AS n_candidates"
    )


_simple("carried_counts", carried_counts, f"""WITH {_M}
SELECT entry_id, CASE WHEN k % 2 = 0 THEN CAST(n_bonds + 100 AS BIGINT) END AS n_bonds,
  CASE WHEN k % 2 = 0 THEN CAST(n_candidates AS BIGINT) END AS n_candidates FROM m""")


# ---- review --------------------------------------------------------------------
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as scored sites, customers as entries with condition summaries."""
    scores = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS entry_id", "o_orderkey",
        "CASE o_orderstatus WHEN 'F' THEN 'SUSPECT' WHEN 'O' THEN 'PASS' ELSE 'REVIEW' END AS site_level",
        "CASE o_orderkey % 4 WHEN 0 THEN 'zn' WHEN 1 THEN 'NI' WHEN 2 THEN '' ELSE 'CA' END AS metal_element",
    )
    summaries = table(spark, sf_dir, "customer").where("c_custkey % 6 <> 0").selectExpr(
        "CAST(c_custkey AS STRING) AS entry_id",
        "CASE WHEN c_acctbal > 2000 THEN 'available' ELSE 'not_reported' END AS data_status",
        "CASE c_nationkey % 4 WHEN 0 THEN array('NI', 'ZN') WHEN 1 THEN array('CA') WHEN 2 THEN array('ZN') ELSE array() END AS metals",
        "c_nationkey % 4 = 0 AS ni_co_like_metal", "FALSE AS heavy_additive_phasing_metal",
        "c_custkey % 2 = 0 AS sulfate", "c_custkey % 5 = 0 AS cacodylate", "c_custkey % 9 = 0 AS acetate",
    )
    queue = runs.review_queue(scores, summaries)
    return queue.select(
        "entry_id", "o_orderkey", "site_level", "data_status", "contains_modeled_metal",
        "contains_different_promiscuous_metal", F.array_join("context_flags", "|").alias("context_flags"),
    )


_simple("review_queue", review_queue, """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal > 2000 THEN 'available' ELSE 'not_reported' END AS st,
    CASE c_nationkey % 4 WHEN 0 THEN ['NI', 'ZN'] WHEN 1 THEN ['CA'] WHEN 2 THEN ['ZN'] ELSE [] END AS ms,
    c_nationkey % 4 = 0 AS ni FROM customer WHERE c_custkey % 6 <> 0),
s AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'SUSPECT' WHEN 'O' THEN 'PASS' ELSE 'REVIEW' END AS lv,
    CASE o_orderkey % 4 WHEN 0 THEN 'ZN' WHEN 1 THEN 'NI' WHEN 2 THEN '' ELSE 'CA' END AS el FROM orders),
j AS (SELECT s.*, c.*, CASE WHEN st = 'available' AND el <> '' THEN list_contains(ms, el) END AS own,
    CASE WHEN st = 'available' THEN list_has_any(list_filter(ms, lambda m: m <> el), ['MN','FE','CO','NI','CU','ZN','CD']) END AS other
  FROM s LEFT JOIN c ON c_custkey = o_custkey WHERE lv <> 'PASS')
SELECT CAST(o_custkey AS VARCHAR) AS entry_id, o_orderkey, lv AS site_level, st AS data_status, own AS contains_modeled_metal,
  other AS contains_different_promiscuous_metal,
  concat_ws('|', CASE WHEN own THEN 'modeled_metal' END, CASE WHEN other THEN 'different_promiscuous_transition_metal' END,
    CASE WHEN ni THEN 'ni_co_like_metal' END, CASE WHEN c_custkey % 2 = 0 THEN 'sulfate' END,
    CASE WHEN c_custkey % 5 = 0 THEN 'cacodylate' END, CASE WHEN c_custkey % 9 = 0 THEN 'acetate' END) AS context_flags
FROM j""")


# ---- incremental ---------------------------------------------------------------
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(spark, sf_dir)
    ids = table(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS STRING) AS entry_id")
    plain_run = runs.pending_entries(ids, runs.done_entries(rows)).withColumn("mode", F.lit("resume"))
    bonds = runs.pending_entries(ids, runs.done_entries(rows, bonds_required=True)).withColumn("mode", F.lit("bonds"))
    retry = runs.pending_entries(ids, runs.done_entries(rows, retry_partials=True)).withColumn("mode", F.lit("retry"))
    capped = runs.pending_entries(ids, runs.done_entries(rows), cap=7).withColumn("mode", F.lit("capped"))
    return plain_run.unionByName(bonds).unionByName(retry).unionByName(capped)


_simple("resume_pending", resume_pending, f"""WITH {_M}
SELECT entry_id, 'resume' AS mode FROM t WHERE NOT terminal
UNION ALL SELECT entry_id, 'bonds' FROM t WHERE NOT (terminal AND (list_contains(rs, 'metal_presence_indeterminate') OR n_bonds IS NOT NULL))
UNION ALL SELECT entry_id, 'retry' FROM t WHERE NOT (terminal AND status = 'ok')
UNION ALL (SELECT entry_id, 'capped' FROM t WHERE NOT terminal ORDER BY entry_id LIMIT 7)""")


def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders replaced per customer by a second status's rows, where the retry ended well."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS entry_id", "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    results = manifest(spark, sf_dir).where("k % 2 = 0")
    return runs.replace_by_key(
        orders.where("o_orderstatus <> 'P'"),
        orders.where("o_orderstatus = 'P'"), runs.replaceable(results),
    )


_simple("replace_by_key", replace_by_key, f"""WITH {_M},
r AS (SELECT k FROM m WHERE k % 2 = 0 AND (status = 'ok' OR (status = 'partial' AND NOT retryable)))
SELECT CAST(o_custkey AS VARCHAR) AS entry_id, o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE (o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT k FROM r)) OR (o_orderstatus = 'P' AND o_custkey IN (SELECT k FROM r))""")


def owned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("CAST(o_custkey AS STRING) AS entry_id", "o_orderkey")
    return runs.owned_rows(orders, runs.done_entries(manifest(spark, sf_dir)))


_simple("owned_rows", owned_rows, f"""WITH {_M}
SELECT CAST(o_custkey AS VARCHAR) AS entry_id, o_orderkey FROM orders WHERE o_custkey IN (SELECT k FROM t WHERE terminal)""")


def artifact_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("CAST(o_custkey AS STRING) AS entry_id")
    return runs.reconcile_counts(manifest(spark, sf_dir), orders, "n_bonds")


_simple("artifact_reconcile", artifact_reconcile, f"""WITH {_M},
a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
j AS (SELECT entry_id, status, CAST(CASE WHEN metal_site_limit_exceeded THEN 0 ELSE coalesce(n_bonds, 0) END AS BIGINT) AS expected,
    coalesce(n, 0) AS actual FROM t LEFT JOIN a ON o_custkey = k WHERE terminal)
SELECT * FROM j WHERE CASE WHEN status = 'ok' THEN actual <> expected ELSE actual > expected END""")


def artifact_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stored tables against one manifest: sites, bonds and candidates from orders and lines."""
    orders = table(spark, sf_dir, "orders").selectExpr("CAST(o_custkey AS STRING) AS entry_id", "o_orderkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber > 4").select(F.col("l_orderkey").alias("o_orderkey"))
    strange = table(spark, sf_dir, "nation").select(F.concat(F.lit(" X"), "n_nationkey").alias("entry_id"))
    return runs.reconcile_tables(manifest(spark, sf_dir), {
        "sites": (orders.where("o_orderstatus = 'P'").select("entry_id").unionByName(strange), "n_metals"),
        "bonds": (orders.select("entry_id"), "n_bonds"),
        "candidates": (orders.join(lines, "o_orderkey").select("entry_id"), "n_candidates"),
    })


_simple("artifact_tables", artifact_tables, f"""WITH {_M},
rows AS (SELECT 'sites' AS "table", CAST(o_custkey AS VARCHAR) AS e FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'sites', 'x' || n_nationkey FROM nation
  UNION ALL SELECT 'bonds', CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'candidates', CAST(o_custkey AS VARCHAR) FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber > 4),
c AS (SELECT "table", e, count(*) AS n FROM rows GROUP BY ALL),
told AS (SELECT 'sites' AS "table", entry_id, status, terminal, metal_site_limit_exceeded AS out, n_metals AS n FROM t
  UNION ALL SELECT 'bonds', entry_id, status, terminal, metal_site_limit_exceeded, n_bonds FROM t
  UNION ALL SELECT 'candidates', entry_id, status, terminal, metal_site_limit_exceeded, n_candidates FROM t),
j AS (SELECT coalesce(a."table", c."table") AS "table", coalesce(a.entry_id, c.e) AS entry_id, status, terminal, out,
    coalesce(a.n, 0) AS s, coalesce(c.n, 0) AS actual, a.entry_id IS NULL AS lone
  FROM told a FULL OUTER JOIN c ON a."table" = c."table" AND a.entry_id = c.e),
r AS (SELECT *, CASE WHEN lone THEN 'unknown_entry' WHEN NOT terminal THEN '' WHEN out THEN CASE WHEN actual > 0 THEN 'none' ELSE '' END
    WHEN status = 'ok' AND actual <> s THEN 'equal' WHEN status <> 'ok' AND actual > s THEN 'at_most' ELSE '' END AS rule FROM j)
SELECT "table", entry_id, status, CASE WHEN lone THEN NULL WHEN out THEN 0 ELSE CAST(s AS BIGINT) END AS stated, actual, rule
FROM r WHERE rule <> ''""")


def manifest_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.manifest_conflicts(manifest(spark, sf_dir))


_simple("manifest_conflicts", manifest_conflicts, f"""WITH {_M},
r AS (SELECT entry_id, CASE WHEN metal_site_limit_exceeded <> list_contains(rs, 'metal_site_limit_exceeded') THEN 'flag_disagrees_with_reason'
  WHEN metal_site_limit_exceeded AND (no_metals OR status <> 'ok' OR n_metals <= 100) THEN 'invalid_exclusion'
  WHEN no_metals AND (status <> 'ok' OR n_metals <> 0) THEN 'invalid_no_metals' END AS rule FROM m)
SELECT * FROM r WHERE rule IS NOT NULL""")


# ---- a whole run ---------------------------------------------------------------
#: Entries that readers failed on: an eighth at the bonds, and some at the input.
FAILURES = """
SELECT DISTINCT concat('e', CAST(CAST(floor(l_orderkey / 40) AS BIGINT) AS STRING)) AS entry_id,
  CASE WHEN floor(l_orderkey / 40) % 8 = 3 THEN 'bonds' ELSE 'input' END AS stage,
  CASE WHEN floor(l_orderkey / 40) % 3 = 1 THEN 'ValueError' ELSE 'OSError' END AS error_class, 'unreadable' AS message
FROM {lineitem} WHERE floor(l_orderkey / 40) % 8 = 3 OR floor(l_orderkey / 40) % 32 = 5
"""
RUN_LIMIT = 12


def entry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atom records to manifest: a run with failures, then a resumed one that mends the bonds."""
    records = cut_lineage(source_atoms(spark, sf_dir))
    frame = bc.cells(spark, sf_dir)
    entries = frame.select(
        "entry_id", (0.05 + F.pmod("entry_no", F.lit(10)) / 100).alias("dpi"),
        F.lit("").alias("dpi_reason"), F.lit(False).alias("searched"))
    failures = derived(spark, sf_dir, FAILURES)
    ids = frame.select("entry_id").unionByName(
        table(spark, sf_dir, "nation").select(F.concat(F.lit("gone"), F.col("n_nationkey")).alias("entry_id")))
    store = EntryStore(
        spark, f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}", run.TABLES, buckets=16)
    told = run.RunOptions(site_limit=RUN_LIMIT, config_id="config-a")
    run.run_entries(spark, ids, run.RunInputs(
        records, entries, literature(spark), failures=failures), store, 0, told)
    run.run_entries(spark, ids, run.RunInputs(
        records, entries, literature(spark), failures=failures.where("stage = 'input'")), store, 1,
        replace(told, resume=True))
    counted = [
        store.read(name).groupBy("entry_id").agg(F.count(F.lit(1)).alias(f"stored_{name}"))
        for name in ("inventory", "sites", "bonds", "candidates")]
    rows = store.read("manifest").drop("analysis_config_id")
    for part in counted:
        rows = rows.join(part, "entry_id", "left")
    return rows.fillna(0).withColumns({
        c: F.array_join(c, "|") for c in ("reason_codes", "warning_codes")})


_simple("entry_run", entry_run, f"""WITH {bc.CONTACT_CTE},
e AS (SELECT entry_id, entry_no, count(*) AS records, count(*) FILTER (element_status <> 'valid') AS unknown FROM source GROUP BY ALL),
m AS (SELECT entry_id, count(*) FILTER (NOT coalesce(ok AND occupancy = 0, FALSE)) AS n,
    count(*) FILTER (coalesce(ok AND occupancy = 0, FALSE)) AS zero,
    count(*) FILTER (NOT coalesce(ok AND occupancy = 0, FALSE) AND (x IS NULL OR y IS NULL OR z IS NULL)) AS lost
  FROM atoms WHERE element IN ({", ".join(f"'{x}'" for x in vocab.METALS)}) GROUP BY entry_id),
site AS (SELECT entry_id, residue_name || '/' || chain_id || '/' || resnum || '/' || atom_name AS site,
    row_number() OVER (PARTITION BY entry_id ORDER BY chain_index, residue_index, atom_index) AS k
  FROM atoms WHERE element IN ({", ".join(f"'{x}'" for x in vocab.METALS)}) AND NOT coalesce(ok AND occupancy = 0, FALSE)
    AND (x IS NULL OR y IS NULL OR z IS NULL)),
why AS (SELECT entry_id, 'geometry unavailable for selected metal site(s) with non-finite coordinates: '
    || string_agg(CASE WHEN k <= 5 THEN site END, ', ' ORDER BY k)
    || CASE WHEN count(*) > 5 THEN ' (and ' || (count(*) - 5) || ' more)' ELSE '' END AS message FROM site GROUP BY entry_id),
pair AS (SELECT DISTINCT entry_id, me || '-' || ne AS pair FROM judged WHERE target IS NULL AND allowed),
bare AS (SELECT entry_id, list(pair ORDER BY pair) AS ps FROM pair GROUP BY entry_id),
c AS (SELECT entry_id, count(*) AS n_candidates, count(*) FILTER (inside AND allowed) AS n_bonds FROM judged GROUP BY entry_id),
j AS (
  SELECT e.*, coalesce(m.n, 0) AS n, coalesce(m.zero, 0) AS zero, coalesce(m.lost, 0) AS lost, why.message, bare.ps,
    coalesce(c.n_candidates, 0) AS nc, coalesce(c.n_bonds, 0) AS nb,
    CASE WHEN entry_no % 32 = 5 THEN 'input' WHEN coalesce(m.n, 0) > {RUN_LIMIT} THEN 'over'
      WHEN coalesce(m.n, 0) = 0 AND unknown > 0 THEN 'unknown' WHEN coalesce(m.n, 0) = 0 THEN 'none' ELSE 'run' END AS way,
    concat_ws('|', CASE WHEN unknown > 0 THEN 'unknown_elements' END,
      CASE WHEN coalesce(m.zero, 0) > 0 THEN 'zero_occupancy_metal_excluded' END) AS ws
  FROM e LEFT JOIN m USING (entry_id) LEFT JOIN why USING (entry_id) LEFT JOIN bare USING (entry_id) LEFT JOIN c USING (entry_id)
),
r AS (
  SELECT *, CASE way WHEN 'input' THEN CASE WHEN entry_no % 3 = 1 THEN 'deterministic_processing_error' ELSE 'unexpected_processing_error' END
    WHEN 'over' THEN 'metal_site_limit_exceeded' WHEN 'unknown' THEN 'metal_presence_indeterminate' WHEN 'none' THEN ''
    ELSE concat_ws('|', CASE WHEN lost > 0 THEN 'non_finite_metal_coordinates' END,
      CASE WHEN ps IS NOT NULL THEN 'missing_first_sphere_reference' END) END AS rs
  FROM j
)
SELECT entry_id, CASE WHEN way = 'input' THEN 'error' WHEN way IN ('over', 'none') OR rs = '' THEN 'ok' ELSE 'partial' END AS status,
  way = 'input' AS retryable, rs AS reason_codes, CASE WHEN way = 'input' THEN '' ELSE ws END AS warning_codes,
  CASE way WHEN 'input' THEN CASE WHEN entry_no % 3 = 1 THEN 'ValueError' ELSE 'OSError' END || ': unreadable'
    WHEN 'unknown' THEN 'cannot establish metal absence: ' || unknown || ' atom(s) have missing or invalid element symbols'
    WHEN 'run' THEN concat_ws('; ', message, CASE WHEN ps IS NOT NULL THEN 'no first-sphere reference for ' || array_to_string(ps[1:5], ', ')
      || CASE WHEN len(ps) > 5 THEN ' (and ' || (len(ps) - 5) || ' more)' ELSE '' END END) ELSE '' END AS status_detail,
  CASE WHEN way = 'input' THEN 0 ELSE n END AS n_metals, CASE WHEN way = 'run' THEN nb ELSE 0 END AS n_bonds,
  CASE WHEN way = 'run' THEN nc ELSE 0 END AS n_candidates, way = 'none' AS no_metals, way = 'over' AS metal_site_limit_exceeded,
  CASE WHEN way = 'input' THEN 0 ELSE 1 END AS stored_inventory, CASE WHEN way = 'run' THEN n ELSE 0 END AS stored_sites,
  CASE WHEN way = 'run' THEN nb ELSE 0 END AS stored_bonds, CASE WHEN way = 'run' THEN nc ELSE 0 END AS stored_candidates
FROM r
UNION ALL SELECT 'gone' || n_nationkey, 'skip', TRUE, 'missing_input', '', 'missing input: no records',
  0, 0, 0, FALSE, FALSE, 0, 0, 0, 0 FROM nation""")
