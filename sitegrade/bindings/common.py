"""Table access and the derived inputs the bound queries share.

A derived input is one SQL text over the supplied tables, written in the subset
both engines read alike: integer arithmetic, IEEE square roots, and ``e0``
double literals. Spark runs it through the DataFrame below; the SQL twins embed
it as a common table expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrade.functions.clean import as_col

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a derived-input SQL text whose tables are written ``{name}``."""
    names = sorted({n for n in re.findall(r"\{(\w+)\}", sql)})
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def plain(sql: str) -> str:
    """The same text with bare table names, for the SQL twin."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def fixed(value: str | Column, places: int = 6) -> Column:
    """``floor(x * 10^n + 1/2) / 10^n``: output rounding both engines compute alike."""
    scale = float(10**places)
    return F.floor(as_col(value) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def fixed_sql(expression: str, places: int = 6) -> str:
    """The SQL spelling of :func:`fixed`."""
    return f"CAST(floor(({expression}) * 1e{places} + 0.5e0) AS DOUBLE) / 1e{places}"


def exact_sql(expression: str, places: int) -> str:
    """The SQL twin of exact binary rounding, on a column or simple expression."""
    s = f"1e{places}"
    x = f"({expression})"
    up = f"({x} * {s} - floor({x} * {s}) - 0.5e0)"
    high = f"({x} * 134217729e0 - ({x} * 134217729e0 - {x}))"
    scale = 10.0**places
    shifted = 134217729.0 * scale
    s_high = shifted - (shifted - scale)
    s_low = scale - s_high
    error = (
        f"((({high} * {s_high!r} - {x} * {s}) + {high} * {s_low!r})"
        f" + ({x} - {high}) * {s_high!r}) + ({x} - {high}) * {s_low!r}"
    )
    odd = f"(abs(floor({x} * {s})) % 2 = 1)"
    return (
        f"(floor({x} * {s}) + CASE WHEN {up} > 0 OR ({up} = 0 AND (({error}) > 0 OR "
        f"(({error}) = 0 AND {odd}))) THEN 1e0 ELSE 0e0 END) / {s}"
    )


#: Contacts: one row per line item, with an observed "distance" near two.
CONTACTS = """
SELECT CAST(l_orderkey AS BIGINT) AS site,
       CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
              CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS contact_id,
       (CAST(l_linenumber AS BIGINT) * 10000000 + l_partkey) * 1000000 + l_suppkey AS contact_order,
       p_brand AS brand, p_type AS kind,
       sqrt(l_extendedprice / l_quantity) / 22e0 AS observed,
       l_tax AS precision_index,
       CAST(l_suppkey AS STRING) AS neighbor_chain,
       CAST(l_partkey AS STRING) AS neighbor_resnum,
       p_type AS neighbor_resname,
       CAST(l_linenumber AS STRING) AS neighbor_atom,
       l_returnflag = 'R' AS declared_connection,
       CASE WHEN l_returnflag = 'R' THEN 'declared'
            WHEN l_returnflag = 'A' THEN 'inferred' ELSE 'unassigned' END AS coordination_status,
       l_suppkey AS supp, l_linestatus AS line_status
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

#: Reference values per (brand, kind); brand 7 lacks exact rows, PROMO has none.
REFERENCE = """
SELECT p_brand AS brand, p_type AS kind,
       min(p_retailprice) / 450e0 AS mu,
       0.2e0 + max(p_size) / 50e0 AS sigma
FROM {part}
WHERE p_brand <> 'Brand#7' AND p_type <> 'PROMO'
GROUP BY p_brand, p_type
"""

#: Sites: one row per order, with a signed density z-score and missing cells.
SITES = """
SELECT CAST(o_custkey AS STRING) AS entry_id,
       CAST(o_orderkey AS STRING) AS metal_site_id,
       CAST(o_orderkey AS BIGINT) AS site,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 97 = 0 THEN 99.9e0
            ELSE (o_totalprice - 250000e0) / 40000e0 END AS zd_main,
       CASE WHEN o_orderkey % 13 = 0 THEN 'no_selected_metal' ELSE 'selected' END
            AS selected_metal_site_status,
       CASE WHEN o_orderkey % 29 = 0 THEN FALSE WHEN o_orderkey % 31 = 0 THEN NULL
            ELSE TRUE END AS metal_coordinates_valid,
       o_orderstatus, o_orderpriority
FROM {orders}
"""

#: Atoms: forty orders make an entry, an order is a residue, a line item an atom.
ATOMS = """
SELECT concat('e', CAST(CAST(floor(l_orderkey / 40) AS BIGINT) AS STRING)) AS entry_id,
  CAST(floor(l_orderkey / 40) AS BIGINT) AS entry_no,
  CASE WHEN l_orderkey % 400 >= 380 AND l_partkey % 3 = 0 THEN 1 ELSE 0 END AS model_index,
  CAST(l_orderkey % 4 AS INT) AS chain_index,
  CAST(floor((l_orderkey % 40) / 4) AS INT) AS residue_index,
  (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 10000 + l_suppkey AS source_order,
  (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 10000 + l_suppkey AS atom_index,
  split_part('A,B,C,D', ',', CAST(l_orderkey % 4 + 1 AS INT)) AS chain_id,
  split_part('ZN,HIS,ASP,CYS,HOH,GLU,SER,HEM,LYS,LIG', ',', CAST(l_orderkey % 10 + 1 AS INT))
    AS residue_name,
  CAST(CAST(floor((l_orderkey % 40) / 4) AS INT) + 1 AS STRING) AS resnum,
  '' AS insertion_code,
  CASE WHEN l_orderkey % 10 = 0
       THEN split_part('ZN,FE,CA,MG,CU,CD,MN,ZN', ',', CAST(l_partkey % 8 + 1 AS INT))
       ELSE split_part(split_part(
         'N,N CA O ND1 NE2 CB CD2,N CA O OD1 OD2 CB OXT,N CA O SG CB OXT H,O O O O H1 O O,N CA O OE1 OE2 CB CG,N CA O OG CB OT1 HG,FE NA NB NC ND C1 O1A,N CA O NZ CB CE CD,O1 N1 S1 C1 C2 O2 P',
         ',', CAST(l_orderkey % 10 + 1 AS INT)), ' ', CAST(l_linenumber AS INT)) END AS atom_name,
  CASE WHEN l_partkey % 5 = 0 THEN l_returnflag ELSE '' END AS altloc,
  CASE WHEN l_partkey % 97 = 0 THEN NULL
       WHEN l_orderkey % 10 = 0
       THEN split_part('ZN,FE,CA,MG,CU,CD,MN,ZN', ',', CAST(l_partkey % 8 + 1 AS INT))
       WHEN l_orderkey % 10 = 7 AND l_linenumber = 1 THEN 'FE'
       ELSE substring(split_part(split_part(
         'N,N CA O ND1 NE2 CB CD2,N CA O OD1 OD2 CB OXT,N CA O SG CB OXT H,O O O O H1 O O,N CA O OE1 OE2 CB CG,N CA O OG CB OT1 HG,FE NA NB NC ND C1 O1A,N CA O NZ CB CE CD,O1 N1 S1 C1 C2 O2 P',
         ',', CAST(l_orderkey % 10 + 1 AS INT)), ' ', CAST(l_linenumber AS INT)), 1, 1) END AS element,
  CASE WHEN l_partkey % 40 = 1 THEN '' WHEN l_partkey % 40 = 2 THEN 'abc'
       WHEN l_partkey % 40 = 3 THEN '1.50' WHEN l_partkey % 40 = 4 THEN '0.00'
       WHEN l_partkey % 40 = 6 THEN 'nan'
       WHEN l_partkey % 5 = 0 AND l_returnflag = 'A' THEN '0.60'
       WHEN l_partkey % 5 = 0 AND l_returnflag = 'N' THEN '0.40'
       WHEN l_partkey % 5 = 0 THEN '0.60' ELSE '1.00' END AS occupancy_raw,
  CASE WHEN l_partkey % 101 = 0 THEN NULL
       ELSE (CAST(round(l_extendedprice * 100e0) AS BIGINT) % 1907) / 100e0 END AS x,
  ((CAST(round(l_extendedprice * 100e0) AS BIGINT) * 7 + l_partkey * 13) % 1801) / 100e0 AS y,
  ((l_suppkey * 31 + l_linenumber * 211 + l_partkey * 3) % 1709) / 100e0 AS z,
  l_quantity + (l_suppkey % 10) / 10e0 AS b_iso,
  l_orderkey % 10 = 4 AS is_water,
  CASE WHEN l_orderkey % 10 IN (0, 4, 7, 9) THEN '-'
       WHEN floor((l_orderkey % 40) / 4) <= 2 THEN 'N'
       WHEN floor((l_orderkey % 40) / 4) >= 7 THEN 'C' ELSE 'M' END AS polymer_position
FROM {lineitem}
"""
