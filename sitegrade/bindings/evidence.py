"""Density and condition queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.bindings.common import Query, derived, fixed, fixed_sql, plain, table
from sitegrade.functions import conditions as fc
from sitegrade.functions.ids import observation_id, split_chain_conformer
from sitegrade.operators import conditions as cond
from sitegrade.operators import density as den
from sitegrade.session import stored

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


# ---- density -------------------------------------------------------------------
def chain_ordinal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as residues of a conversation; a role repeats, so ordinals settle it."""
    talks = table(spark, sf_dir, "conversations")
    residues = talks.select("conv_id", "role", "turn")
    rows = talks.select(
        "conv_id", "role",
        (F.col("turn") + F.when(F.col("turn") % 5 == 4, 40).otherwise(1)).alias("nr"),
    )
    return den.resolve_rows(
        rows, residues, ["conv_id", "role"], ["conv_id"], "turn", "nr"
    ).select("conv_id", "role", "nr", "residue_pos", "mapping_status")


QUERIES["chain_ordinal_join"] = chain_ordinal_join
ORACLES["chain_ordinal_join"] = """
WITH placed AS (SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS o,
    count(*) OVER (PARTITION BY conv_id, role) AS n FROM conversations),
rows_ AS (SELECT conv_id, role, turn + CASE WHEN turn % 5 = 4 THEN 40 ELSE 1 END AS nr FROM conversations)
SELECT r.conv_id, r.role, r.nr, p.turn AS residue_pos,
  CASE WHEN p.turn IS NULL THEN 'ambiguous' ELSE 'matched' END AS mapping_status
FROM rows_ r LEFT JOIN placed p ON r.conv_id = p.conv_id AND r.role = p.role AND (p.n = 1 OR p.o = r.nr)
"""


def conformer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as statistics rows labelled supplier:flag; an order selects one flag."""
    lines = table(spark, sf_dir, "lineitem")
    label = F.when(
        F.col("l_linenumber") == 1, F.col("l_suppkey").cast("string")
    ).when(
        F.col("l_partkey") % 50 == 0, F.concat(F.col("l_suppkey").cast("string"), F.lit(":AB"))
    ).otherwise(F.concat_ws(":", F.col("l_suppkey").cast("string"), "l_returnflag"))
    selected = F.when(F.col("l_orderkey") % 4 == 0, "R").when(
        F.col("l_orderkey") % 4 == 1, "A").when(F.col("l_orderkey") % 4 == 2, "")
    rows = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        label.alias("label"), selected.alias("selected"),
    )
    chain, conformer, _ = split_chain_conformer("label")
    return den.keep_selected_conformers(rows, "label", "selected").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", chain.alias("chain"),
        conformer.alias("conformer"), "problem",
    )


QUERIES["conformer_rows"] = conformer_rows
ORACLES["conformer_rows"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_suppkey AS VARCHAR) AS chain,
  CASE WHEN l_linenumber = 1 THEN '' WHEN l_partkey % 50 = 0 THEN 'AB' ELSE l_returnflag END AS conformer,
  CASE l_orderkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'A' WHEN 2 THEN '' END AS sel FROM lineitem),
p AS (SELECT *, CASE WHEN len(conformer) > 1 THEN 'invalid_label'
    WHEN sel IS NULL AND conformer <> '' THEN 'unmatched_conformer'
    WHEN coalesce(sel, '') = '' AND conformer <> '' THEN 'conformer_without_selection' ELSE '' END AS problem FROM r)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, chain, conformer, problem FROM p
WHERE problem <> '' OR coalesce(sel, '') = '' OR conformer = sel
"""


def share_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as observed residues, suppliers as their metals."""
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS nation", "n_name")
    metals = table(spark, sf_dir, "supplier").where(F.col("s_nationkey") % 4 != 0).selectExpr(
        "s_nationkey AS nation", "s_suppkey"
    )
    return den.fan_out(nations, metals, ["nation"])


QUERIES["share_multiplicity"] = share_multiplicity
ORACLES["share_multiplicity"] = """
SELECT n_nationkey AS nation, n_name, s_suppkey, count(s_suppkey) OVER (PARTITION BY n_nationkey) AS density_shared_site_count,
  count(s_suppkey) OVER (PARTITION BY n_nationkey) > 1 AS density_is_shared,
  CASE WHEN s_suppkey IS NULL THEN 'no_selected_metal' ELSE 'selected' END AS selected_metal_site_status
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_nationkey % 4 <> 0
"""


def multiset_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands expected once per part, observed once per cheap line item."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"))
    seen = table(spark, sf_dir, "lineitem").where("l_extendedprice < 2000").join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return den.missing_multiset(parts, seen, ["brand", "kind"])


QUERIES["multiset_missing"] = multiset_missing
ORACLES["multiset_missing"] = """
SELECT brand, kind, count(*) AS missing FROM (
  SELECT p_brand AS brand, p_type AS kind FROM part
  EXCEPT ALL SELECT p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_extendedprice < 2000)
GROUP BY ALL
"""


def missing_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = table(spark, sf_dir, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return den.without_statistics(table(spark, sf_dir, "part").select("p_partkey", "p_name"), sold, ["p_partkey"])


QUERIES["missing_expected"] = missing_expected
ORACLES["missing_expected"] = """
SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)
"""


def density_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sites: even ones have a row of their own, odd ones only an author name."""
    orders = table(spark, sf_dir, "orders")
    sites = orders.selectExpr("o_orderkey", "o_custkey", "o_orderpriority")
    rows = orders.where("o_orderkey % 3 <> 0").selectExpr(
        "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS o_orderkey",
        "o_custkey", "o_orderpriority", "o_totalprice AS zd",
    )
    return den.density_lookup(sites, rows, ["o_orderkey"], ["o_custkey", "o_orderpriority"], ["zd"])


QUERIES["density_lookup"] = density_lookup
ORACLES["density_lookup"] = """
WITH r AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS k, o_custkey AS c, o_orderpriority AS p,
             o_totalprice AS zd FROM orders WHERE o_orderkey % 3 <> 0),
u AS (SELECT c, p, max(zd) AS zd FROM r GROUP BY ALL HAVING count(*) = 1)
SELECT o_orderkey, o_custkey, o_orderpriority, CASE WHEN r.k IS NOT NULL THEN r.zd ELSE u.zd END AS zd
FROM orders LEFT JOIN r ON r.k = o_orderkey LEFT JOIN u ON u.c = o_custkey AND u.p = o_orderpriority
"""


def density_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as entries, events as residues: signups are targets, views are waters."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "user_id AS entry_id", "event_type = 'signup' AS is_target", "event_type = 'view' AS is_water",
        "CASE WHEN event_type <> 'error' OR value > 5 THEN value - 20D END AS zd_all",
    )
    context = den.density_context(rows)
    return context.select(
        *[fixed(c).alias(c) if "fraction" in c or "median" in c else F.col(c) for c in context.columns]
    )


def _context_sql(name: str, rule: str) -> str:
    v = f"CASE WHEN {rule} THEN a END"
    return f"""count(*) FILTER ({rule}) AS {name}_residue_count, count({v}) AS {name}_rszd_count,
  {fixed_sql(f"median({v})")} AS {name}_median_abs_rszd,
  count(*) FILTER ({rule} AND a >= 3) AS {name}_abs_rszd_ge_3_count,
  count(*) FILTER ({rule} AND a >= 6) AS {name}_abs_rszd_ge_6_count,
  {fixed_sql(f"CASE WHEN count({v}) > 0 THEN count(*) FILTER ({rule} AND a >= 3) / count({v}) END")} AS {name}_abs_rszd_ge_3_fraction,
  {fixed_sql(f"CASE WHEN count({v}) > 0 THEN count(*) FILTER ({rule} AND a >= 6) / count({v}) END")} AS {name}_abs_rszd_ge_6_fraction"""


QUERIES["density_context"] = density_context
ORACLES["density_context"] = f"""
WITH r AS (SELECT user_id, event_type AS t, CASE WHEN event_type <> 'error' OR value > 5 THEN abs(value - 20e0) END AS a FROM events)
SELECT user_id AS entry_id, count(*) AS residue_count_all, count(*) FILTER (t = 'signup') AS target_residue_count,
  {_context_sql("ordinary", "t <> 'signup'")},
  {_context_sql("ordinary_nonwater", "t NOT IN ('signup', 'view')")},
  {_context_sql("water", "t = 'view'")}
FROM r GROUP BY user_id
"""


def density_context_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly one context row per customer, computed only for those with events."""
    entries = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entry_id"))
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("entry_id")).agg(
        F.count(F.lit(1)).alias("residue_count")
    ).withColumn("density_context_status", F.lit("available"))
    return den.with_defaults(entries, rows, "entry_id", {"density_context_status": "not_computed"})


QUERIES["density_context_rows"] = density_context_rows
ORACLES["density_context_rows"] = """
SELECT c_custkey AS entry_id, n AS residue_count,
  CASE WHEN n IS NULL THEN 'not_computed' ELSE 'available' END AS density_context_status
FROM customer LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) ON user_id = c_custkey
"""


def residue_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as residues: fragile brands are the catalog, cheap lines the metals."""
    residues = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(F.col("l_quantity") < 5).alias("metals"),
        F.count_distinct("l_suppkey").alias("sites"),
    )
    catalog = F.col("l_orderkey") % 9 == 0
    category = den.residue_category(catalog, F.col("metals"), F.col("sites"))
    kind = den.component_class(
        F.col("l_orderkey") % 18 == 0, catalog, F.col("sites")
    )
    status = F.when(F.col("l_orderkey") % 5 == 0, "coordinate_residue_not_found").otherwise("matched")
    site = F.when(F.col("metals") > 0, "selected").otherwise("no_selected_metal")
    return residues.select(
        "l_orderkey", category.alias("category"), kind.alias("parent_type"),
        den.identification_codes(status, site).alias("reason_code"),
        observation_id(
            F.col("l_orderkey").cast("string"), F.lit(1), F.when(F.col("l_orderkey") % 2 == 0, "A").otherwise(""),
            F.col("metals"), F.lit("ZN"), F.col("sites"),
        ).alias("observation_id"),
    )


QUERIES["residue_categories"] = residue_categories
ORACLES["residue_categories"] = """
WITH r AS (SELECT l_orderkey AS k, count(*) FILTER (l_quantity < 5) AS m, count(DISTINCT l_suppkey) AS s FROM lineitem GROUP BY 1)
SELECT k AS l_orderkey, CASE WHEN k % 9 = 0 THEN 'cofactor' WHEN m > 0 AND s = 1 THEN 'metal' WHEN m > 0 THEN 'cofactor' ELSE '' END AS category,
  CASE WHEN k % 18 = 0 THEN 'cluster' WHEN k % 9 = 0 THEN 'heme' WHEN s = 1 THEN 'ion' ELSE 'other' END AS parent_type,
  CASE WHEN k % 5 = 0 THEN 'cofactor_coordinate_join_failed' WHEN m = 0 THEN 'cofactor_without_selected_metal' END AS reason_code,
  k || '/model=1/chain=' || CASE WHEN k % 2 = 0 THEN 'A' ELSE '_' END || '/residue=' || m || '/component=ZN/edstats_row=' || s AS observation_id
FROM r
"""


# ---- conditions ----------------------------------------------------------------
#: Condition texts: a whole document followed by a stated condition.
CONDITION_TEXT = """
SELECT doc_id, CAST(floor(doc_id / 4) AS BIGINT) AS entry_no,
  concat('d', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING)) AS entry_id,
  concat(text, ' , ', CASE doc_id % 12
    WHEN 0 THEN '20% PEG 3350, 10 MM NICL2, PH 6.8, TEMPERATURE 291K, HANGING DROP'
    WHEN 1 THEN 'PROTEIN 5 MG/ML, 0.1 M HEPES PH 7.5, temperature 20 C, sitting drop'
    WHEN 2 THEN '0.2 M NaBr, 0.1 M Bis-Tris pH 6.5, Temp. 18.5 DEG C'
    WHEN 3 THEN 'CO-CRYSTALLIZED WITH LIGAND, vapor diffusion, pH 5.5 - 6.5'
    WHEN 4 THEN '10 mM CoCl2, 1 mM lead acetate, PH 8.5 - 10% PEG 4000'
    WHEN 5 THEN 'sodium cacodylate, AMMONIUM SULFATE, TEMPERATURE 20'
    WHEN 6 THEN '0.2 M Mg acetate, calcium chloride, pH: 7, temperature = 277.0 KELVIN, batch'
    WHEN 7 THEN 'YB2SO4 and CaCl2NiCl2, dialysis, pH range 4.0-4.5'
    WHEN 8 THEN '0.1 M KI, HEPES-NaOH pH 7.5, TEMPERATURE 293, MICROBATCH'
    WHEN 9 THEN 'trimethyl lead acetate and Zn2+, pH 19'
    WHEN 10 THEN '5 MG PROTEIN IN 0.2 M MG ACETATE, sulphate'
    ELSE '' END) AS text
FROM {documents}
"""


def condition_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, CONDITION_TEXT)


def condition_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    mined = condition_texts(spark, sf_dir).withColumn("metals", fc.metals_in_text("text"))
    return mined.select(
        "doc_id",
        F.array_join("metals", "|").alias("metals"),
        fc.ph_value("text").alias("ph"), fc.ph_range("text").alias("ph_range"),
        fc.temperature_kelvin("text").alias("temperature"),
        fc.method_keyword("text").alias("method"),
        *[c.alias(n) for n, c in fc.ingredient_flags("text").items()],
        *[c.alias(n) for n, c in fc.metal_class_flags("metals").items()],
    )


def _metal_sql() -> str:
    """Metals of a text in RE2, one condition per metal, without look-around."""
    cases = []
    for symbol in sorted(vocab.METAL_NAMES):
        title = symbol.title()
        both = f"({title}|{symbol})"
        rules = [
            f"regexp_matches(lower(t), '(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(vocab.METAL_NAMES[symbol])})($|[^\\p{{L}}\\p{{N}}_])')",
            f"regexp_matches(t, '(^|[^A-Za-z]){both}([0-9]|[A-Z(][A-Za-z0-9()]*[0-9])')",
        ]
        if len(symbol) > 1:
            rules.append(
                f"regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_]){both}($|-$|-[^A-Za-z]|[^\\p{{L}}\\p{{N}}_-])')"
            )
        if symbol in vocab.SALT_METALS:
            salts = "|".join([title + a for a in vocab.SALT_ANIONS] + [symbol + a.upper() for a in vocab.SALT_ANIONS])
            rules.append(f"regexp_matches(t, '(^|[^A-Za-z])({salts})($|[^A-Za-z])')")
        cases.append(f"CASE WHEN {' OR '.join(rules)} THEN '{symbol}' END")
    return "[" + ", ".join(cases) + "]"


_CLASS_SQL = ", ".join(
    f"list_has_any(ms, {list(symbols)!r}) AS {name}"
    for name, symbols in (
        ("promiscuous_transition_metal", vocab.PROMISCUOUS_METALS),
        ("ni_co_like_metal", vocab.NI_CO_METALS),
        ("buffer_light_metal", vocab.BUFFER_METALS),
        ("heavy_additive_phasing_metal", vocab.HEAVY_METALS),
    )
)
_METHOD_SQL = " ".join(f"WHEN contains(lower(text), '{m}') THEN '{m}'" for m in vocab.METHOD_LABELS)
_MINED_CTE = f"""
texts AS ({plain(CONDITION_TEXT)}),
cleaned AS (SELECT *, regexp_replace(text, '(^|[^A-Za-z])(MG|Mg)\\s*/\\s*([MDUmdu]|µ)?L\\b|[0-9][0-9.]*\\s*MG\\b', '\\1 ', 'g') AS t FROM texts),
mined AS (
  SELECT doc_id, entry_id, entry_no, text, list_filter({_metal_sql()}, lambda m: m IS NOT NULL) AS ms,
    regexp_extract(text, '(?i)\\bp\\s*h\\s*(?:range)?\\s*(?:=|:)?\\s*(-?[0-9]+(?:\\.[0-9]+)?)\\s*[-–]\\s*(-?[0-9]+(?:\\.[0-9]+)?)([0-9.]*\\s*%)?', ['lo', 'hi', 'pc']) AS r,
    regexp_extract(text, '(?i)\\bp\\s*h\\s*(?:=|:)?\\s*(-?[0-9]+(?:\\.[0-9]+)?)', 1) AS p,
    regexp_extract(text, '(?i)\\b(?:temperature|temp\\.?)\\s*(?:=|:)?\\s*([0-9]+(?:\\.[0-9]+)?)\\s*(?:(k\\b|kelvin\\b)|((?:deg(?:rees?)?\\.?\\s*|°\\s*)?(?:c\\b|celsius\\b|centigrade\\b)))?', ['v', 'k', 'c']) AS h
  FROM cleaned
),
facts AS (
  SELECT *, CASE WHEN r.lo <> '' AND r.pc = '' THEN r.lo || '-' || r.hi ELSE '' END AS ph_range,
    CASE WHEN r.lo <> '' AND r.pc = '' THEN '' ELSE p END AS ph,
    CASE WHEN h.v = '' THEN '' WHEN h.c <> '' THEN CAST(CAST(TRY_CAST(h.v AS DECIMAL(20,6)) + 273.15 AS DECIMAL(20,2)) AS VARCHAR)
      WHEN h.k <> '' OR TRY_CAST(h.v AS DOUBLE) BETWEEN 150 AND 400 THEN h.v ELSE '' END AS temperature,
    CASE {_METHOD_SQL} ELSE '' END AS method
  FROM mined
)"""
QUERIES["condition_mining"] = condition_mining
ORACLES["condition_mining"] = f"""
WITH {_MINED_CTE}
SELECT doc_id, array_to_string(ms, '|') AS metals, ph, ph_range, temperature, method,
  contains(lower(text), 'sulfate') OR contains(lower(text), 'sulphate') AS sulfate,
  contains(lower(text), 'cacodylate') AS cacodylate, contains(lower(text), 'acetate') AS acetate,
  len(ms) > 0 AS any_metal, {_CLASS_SQL}
FROM facts
"""


def condition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts wrapped as REMARK 280 blocks, mined back into numbered condition rows."""
    texts = condition_texts(spark, sf_dir)
    lines = F.transform(F.split("text", "\n"), lambda s: F.concat(F.lit("REMARK 280 "), s))
    stated = F.when(
        F.col("doc_id") % 5 == 0, F.lit("REMARK 280 CRYSTALLIZATION CONDITIONS: NULL")
    ).otherwise(F.concat(F.lit("REMARK 280 CRYSTALLIZATION CONDITIONS:\n"), F.array_join(lines, "\n")))
    files = texts.select(
        "entry_id", F.col("doc_id").alias("position"),
        F.concat(F.lit("HEADER    X\nREMARK 280 SOLVENT CONTENT, VS (%): 45.00\n"), stated, F.lit("\nEND")).alias("text"),
    )
    # numbers and summaries read the mined rows several times: texts are mined once
    return cond.number_conditions(stored(cond.from_remarks(files)))


def condition_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return condition_rows(spark, sf_dir).select(
        "entry_id", "ordinal", "condition_id", "method", "pH", "pH_range", "temperature_K",
        F.sha2("raw_details", 256).alias("details_sha"),
    )


#: The document as REMARK lines joined again: trimmed pieces, blanks dropped.
_JOINED = "array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(s, ' ')), lambda s: s <> ''), ' ')"
QUERIES["condition_records"] = condition_records
ORACLES["condition_records"] = f"""
WITH {_MINED_CTE},
kept AS (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY doc_id) AS n FROM facts WHERE doc_id % 5 <> 0)
SELECT entry_id, n AS ordinal, entry_id || ':condition:' || n AS condition_id, method, ph AS pH,
  ph_range AS pH_range, temperature AS temperature_K, sha256({_JOINED}) AS details_sha
FROM kept
"""


def condition_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = cond.summarize_conditions(condition_rows(spark, sf_dir))
    return summary.select(
        "entry_id", "condition_count", F.array_join("condition_ids", "|").alias("condition_ids"),
        "pH_min", "pH_max", fixed("temperature_min_K").alias("temperature_min_K"),
        fixed("temperature_max_K").alias("temperature_max_K"),
        F.array_join("metals", "|").alias("metals"), F.sha2("raw_text", 256).alias("text_sha"),
        *cond.FLAGS,
    )


QUERIES["condition_summary"] = condition_summary
ORACLES["condition_summary"] = f"""
WITH {_MINED_CTE},
kept AS (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY doc_id) AS n, {_JOINED} AS details,
    list_filter(list_transform([ph, r.lo, r.hi], lambda s, i: CASE WHEN i = 1 OR ph_range <> '' THEN TRY_CAST(s AS DOUBLE) END),
      lambda v: v IS NOT NULL AND v >= 0 AND v <= 14) AS phs FROM facts WHERE doc_id % 5 <> 0),
firsts AS (SELECT entry_id, details, min(n) AS n FROM kept GROUP BY ALL),
joined AS (SELECT entry_id, string_agg(details, ' || ' ORDER BY n) AS raw FROM firsts GROUP BY entry_id),
s AS (SELECT entry_id, count(*) AS condition_count, string_agg(entry_id || ':condition:' || n, '|' ORDER BY n) AS condition_ids,
    min(list_min(phs)) AS pH_min, max(list_max(phs)) AS pH_max,
    min(TRY_CAST(temperature AS DOUBLE)) AS t0, max(TRY_CAST(temperature AS DOUBLE)) AS t1,
    list_sort(list_distinct(flatten(list(ms)))) AS ms,
    bool_or(contains(lower(text), 'sulfate') OR contains(lower(text), 'sulphate')) AS sulfate,
    bool_or(contains(lower(text), 'cacodylate')) AS cacodylate, bool_or(contains(lower(text), 'acetate')) AS acetate
  FROM kept GROUP BY entry_id)
SELECT entry_id, condition_count, condition_ids, pH_min, pH_max, {fixed_sql("t0")} AS temperature_min_K,
  {fixed_sql("t1")} AS temperature_max_K, array_to_string(ms, '|') AS metals, sha256(raw) AS text_sha,
  len(ms) > 0 AS any_metal, {_CLASS_SQL}, sulfate, cacodylate, acetate
FROM s JOIN joined USING (entry_id)
"""


def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping halves of the customers as competing sources, both ways round."""
    customers = table(spark, sf_dir, "customer")
    local = customers.where("c_custkey % 5 <> 0").selectExpr(
        "c_custkey AS entry_id", "CASE WHEN c_acctbal > 0 THEN 'available' ELSE 'not_reported' END AS status"
    )
    deposited = customers.where("c_custkey % 3 <> 0").selectExpr(
        "c_custkey AS entry_id",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'available' ELSE 'input_unavailable' END AS status",
    )
    first = cond.choose_source(local, deposited).selectExpr("entry_id", "chosen", "status")
    second = cond.choose_source(local, deposited, prefer_local=True).selectExpr(
        "entry_id", "chosen AS manual_chosen", "status AS manual_status"
    )
    return first.join(second, "entry_id")


QUERIES["source_precedence"] = source_precedence
ORACLES["source_precedence"] = """
WITH b AS (SELECT c_custkey AS entry_id,
  CASE WHEN c_custkey % 5 <> 0 THEN CASE WHEN c_acctbal > 0 THEN 'available' ELSE 'not_reported' END END AS l,
  CASE WHEN c_custkey % 3 <> 0 THEN CASE WHEN c_nationkey % 2 = 0 THEN 'available' ELSE 'input_unavailable' END END AS d
  FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 3 <> 0),
c AS (SELECT *, CASE WHEN d IS NULL THEN 'local' WHEN d = 'available' THEN 'deposited' WHEN l = 'available' THEN 'local' ELSE 'deposited' END AS chosen,
  CASE WHEN d IS NULL OR coalesce(l, '') = 'available' THEN 'local' WHEN d = 'available' THEN 'deposited' ELSE 'local' END AS manual_chosen FROM b)
SELECT entry_id, chosen, CASE chosen WHEN 'local' THEN l ELSE d END AS status, manual_chosen,
  CASE manual_chosen WHEN 'local' THEN l ELSE d END AS manual_status FROM c
"""


def cache_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested documents against labels as cached responses."""
    requested = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("entry_id"))
    payloads = table(spark, sf_dir, "labels").selectExpr(
        "CAST(doc_id AS STRING) AS entry_id", "quality = 1 AS entry_available", "toxic AS condition_count"
    )
    return cond.cache_coverage(requested, payloads)


QUERIES["cache_coverage"] = cache_coverage
ORACLES["cache_coverage"] = """
SELECT count(*) AS requested, count(quality) AS cache_hits, count(*) FILTER (quality = 1 AND toxic > 0) AS available,
  count(*) FILTER (quality = 1 AND toxic = 0) AS not_reported, count(*) FILTER (quality <> 1) AS entry_unavailable,
  count(*) FILTER (quality IS NULL) AS not_fetched
FROM documents LEFT JOIN labels USING (doc_id)
"""


def request_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("entry_id"))
    responses = table(spark, sf_dir, "labels").selectExpr("CAST(doc_id AS STRING) AS entry_id", "quality")
    return cond.reconcile_requests(requested, responses)


QUERIES["request_reconciliation"] = request_reconciliation
ORACLES["request_reconciliation"] = """
SELECT CAST(doc_id AS VARCHAR) AS entry_id, quality, quality IS NOT NULL AS entry_available
FROM documents LEFT JOIN labels USING (doc_id)
"""


# ---- conditions of the winning source ------------------------------------------
#: Orders as local conditions and large lines as deposited ones of customers.
LOCAL_CONDITIONS = """
SELECT CAST(o_custkey AS STRING) AS entry_id, o_orderkey AS position, '' AS crystal_id, 'VAPOR DIFFUSION' AS method,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(4 + o_orderkey % 7 AS STRING) ELSE '' END AS pH, '' AS pH_range,
  CAST(270 + o_orderkey % 40 AS STRING) AS temperature_K, '' AS temperature_details,
  CASE WHEN o_orderkey % 2 = 0 THEN concat('salt ', CAST(o_orderkey % 10 AS STRING)) ELSE '' END AS raw_details
FROM {orders} WHERE o_custkey % 4 <> 1
"""
DEPOSITED_CONDITIONS = """
SELECT CAST(o_custkey AS STRING) AS entry_id, l_orderkey * 10 + l_linenumber AS position, '1' AS crystal_id,
  CASE WHEN l_linenumber = 1 THEN '' ELSE 'BATCH' END AS method, '' AS pH, '' AS pH_range, '' AS temperature_K,
  '' AS temperature_details, '' AS raw_details
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_quantity > 45
"""


def _read_conditions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, cond.ConditionSource, cond.ConditionSource]:
    customers = table(spark, sf_dir, "customer")
    local = customers.where("c_custkey % 5 <> 0").selectExpr(
        "CAST(c_custkey AS STRING) AS entry_id", "c_custkey % 8 <> 1 AS present", "c_custkey % 6 <> 1 AS parsed",
        "'pdb' AS source_format", "'coordinate_file' AS metadata_source", "CAST(NULL AS STRING) AS retrieved_at_utc",
        "CAST(NULL AS STRING) AS entry_revision_date")
    deposited = customers.where("c_custkey % 3 <> 0").selectExpr(
        "CAST(c_custkey AS STRING) AS entry_id", "c_nationkey % 2 = 0 AS present", "true AS parsed",
        "'json' AS source_format", "'service' AS metadata_source", "'2020' AS retrieved_at_utc", "'2019' AS entry_revision_date")
    return (
        customers.select(F.col("c_custkey").cast("string").alias("entry_id")),
        cond.ConditionSource(derived(spark, sf_dir, LOCAL_CONDITIONS).join(
            local.where("parsed AND present").select("entry_id"), "entry_id", "left_semi"), local),
        cond.ConditionSource(derived(spark, sf_dir, DEPOSITED_CONDITIONS).join(
            deposited.select("entry_id"), "entry_id", "left_semi"), deposited))


def condition_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary of every customer from the source that wins, default rows included."""
    entries, local, deposited = _read_conditions(spark, sf_dir)
    _, summary = cond.condition_context(entries, local, deposited)
    return summary.select(
        "entry_id", "chosen", "status", "source_format", "metadata_source", "retrieved_at_utc", "entry_revision_date",
        "condition_count", "pH_min", "pH_max", "temperature_min_K", "temperature_max_K", "any_metal",
        F.array_join("metals", "|").alias("metals"), "raw_text")


def winning_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condition rows of the winning sources, the local one preferred."""
    entries, local, deposited = _read_conditions(spark, sf_dir)
    rows, _ = cond.condition_context(entries, local, deposited, prefer_local=True)
    return rows.select("entry_id", "position", "ordinal", "method", "metadata_source")


_CONTEXT_CTE = f"""l0 AS (SELECT c_custkey AS k, c_custkey % 8 <> 1 AS present, c_custkey % 6 <> 1 AS parsed FROM customer WHERE c_custkey % 5 <> 0),
d0 AS (SELECT c_custkey AS k, c_nationkey % 2 = 0 AS present FROM customer WHERE c_custkey % 3 <> 0),
lr AS (SELECT r.*, row_number() OVER (PARTITION BY entry_id ORDER BY position) AS ordinal FROM ({plain(LOCAL_CONDITIONS)}) r
  JOIN l0 ON entry_id = CAST(k AS VARCHAR) WHERE present AND parsed),
dr AS (SELECT r.*, row_number() OVER (PARTITION BY entry_id ORDER BY position) AS ordinal FROM ({plain(DEPOSITED_CONDITIONS)}) r
  JOIN d0 ON entry_id = CAST(k AS VARCHAR) WHERE r.method <> ''),
ls AS (SELECT c_custkey AS k, CASE WHEN l0.k IS NULL THEN 'input_unavailable' WHEN CAST(c_custkey AS VARCHAR) IN (SELECT entry_id FROM lr) THEN 'available'
    WHEN NOT present THEN 'input_unavailable' WHEN NOT parsed THEN 'unparseable' ELSE 'not_reported' END AS l, l0.k IS NOT NULL AS lk
  FROM customer LEFT JOIN l0 ON l0.k = c_custkey),
ds AS (SELECT k, CASE WHEN CAST(k AS VARCHAR) IN (SELECT entry_id FROM dr) THEN 'available' WHEN NOT present THEN 'input_unavailable'
    ELSE 'not_reported' END AS d FROM d0),
pick AS (SELECT ls.k, l, d, lk, CASE WHEN d IS NULL THEN 'local' WHEN d = 'available' THEN 'deposited' WHEN l = 'available' THEN 'local' ELSE 'deposited' END AS chosen,
    CASE WHEN d IS NULL OR l = 'available' THEN 'local' WHEN d = 'available' THEN 'deposited' ELSE 'local' END AS manual
  FROM ls LEFT JOIN ds ON ds.k = ls.k)"""
QUERIES["condition_context"] = condition_context
ORACLES["condition_context"] = f"""WITH {_CONTEXT_CTE},
won AS (SELECT lr.* FROM lr JOIN pick ON entry_id = CAST(k AS VARCHAR) WHERE chosen = 'local'
  UNION ALL SELECT dr.* FROM dr JOIN pick ON entry_id = CAST(k AS VARCHAR) WHERE chosen = 'deposited'),
t AS (SELECT entry_id, string_agg(raw_details, ' || ' ORDER BY first_at) AS raw FROM (
    SELECT entry_id, raw_details, min(ordinal) AS first_at FROM won WHERE raw_details <> '' GROUP BY ALL) GROUP BY entry_id),
s AS (SELECT entry_id, count(*) AS n, min(try_cast(pH AS DOUBLE)) AS lo, max(try_cast(pH AS DOUBLE)) AS hi,
    min(try_cast(temperature_K AS DOUBLE)) AS cold, max(try_cast(temperature_K AS DOUBLE)) AS warm FROM won GROUP BY entry_id)
SELECT CAST(k AS VARCHAR) AS entry_id, chosen, CASE chosen WHEN 'local' THEN l ELSE d END AS status,
  CASE WHEN chosen = 'deposited' THEN 'json' WHEN lk THEN 'pdb' ELSE '' END AS source_format,
  CASE WHEN chosen = 'deposited' THEN 'service' WHEN lk THEN 'coordinate_file' ELSE '' END AS metadata_source,
  CASE WHEN chosen = 'deposited' THEN '2020' ELSE '' END AS retrieved_at_utc,
  CASE WHEN chosen = 'deposited' THEN '2019' ELSE '' END AS entry_revision_date,
  coalesce(n, 0) AS condition_count, lo AS pH_min, hi AS pH_max, cold AS temperature_min_K, warm AS temperature_max_K,
  FALSE AS any_metal, '' AS metals, coalesce(raw, '') AS raw_text
FROM pick LEFT JOIN s ON s.entry_id = CAST(k AS VARCHAR) LEFT JOIN t ON t.entry_id = CAST(k AS VARCHAR)"""
QUERIES["winning_conditions"] = winning_conditions
ORACLES["winning_conditions"] = f"""WITH {_CONTEXT_CTE}
SELECT entry_id, position, ordinal, method, 'coordinate_file' AS metadata_source FROM lr JOIN pick ON entry_id = CAST(k AS VARCHAR) WHERE manual = 'local'
UNION ALL SELECT entry_id, position, ordinal, method, 'service' FROM dr JOIN pick ON entry_id = CAST(k AS VARCHAR) WHERE manual = 'deposited'"""
