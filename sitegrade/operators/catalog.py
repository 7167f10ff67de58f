"""Metal-bearing components: formulas, clusters, hemes, and the catalog."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade import vocab

#: Fixed format: an element symbol and its count in a formula.
FORMULA_TERM = r"([A-Z][a-z]?)(\d*)"


def formula_elements(formulas: DataFrame, key: str, formula: str) -> DataFrame:
    """Atoms per element of each formula: ``key, element, count``."""
    symbols = F.regexp_extract_all(F.coalesce(formula, F.lit("")), F.lit(FORMULA_TERM), F.lit(1))
    numbers = F.regexp_extract_all(F.coalesce(formula, F.lit("")), F.lit(FORMULA_TERM), F.lit(2))
    terms = formulas.select(key, F.explode(F.arrays_zip(symbols.alias("s"), numbers.alias("n"))).alias("t"))
    return terms.groupBy(key, F.upper("t.s").alias("element")).agg(
        F.sum(F.when(F.col("t.n") == "", 1).otherwise(F.col("t.n").cast("long"))).alias("count")
    )


def formula_has_metal(formula: str | Column) -> Column:
    """Whether a formula names a recognised metal."""
    text = F.col(formula) if isinstance(formula, str) else formula
    symbols = F.transform(
        F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(FORMULA_TERM), F.lit(1)),
        lambda s: F.upper(s),
    )
    return F.arrays_overlap(symbols, F.array(*[F.lit(m) for m in vocab.METALS]))


def both_ways(bonds: DataFrame) -> DataFrame:
    """Undirected bonds as (component, from_atom, to_atom) in both directions."""
    forward = bonds.selectExpr("component_id", "atom_id_1 AS from_atom", "atom_id_2 AS to_atom")
    return forward.unionByName(
        forward.selectExpr("component_id", "to_atom AS from_atom", "from_atom AS to_atom")
    ).distinct()


def cluster_components(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """Components with an S or Se bonded to two or more cluster metals.

    Bonds of components without such atoms leave before any bond is matched.
    """
    able = atoms.groupBy("component_id").agg(
        F.count_if(F.col("element").isin(*vocab.CLUSTER_CHALCOGENS)).alias("chalcogens"),
        F.count_if(F.col("element").isin(*vocab.CLUSTER_METALS)).alias("metals"),
    ).where(F.col("chalcogens") * F.col("metals") >= 2)
    edges = both_ways(bonds.join(able, "component_id", "left_semi"))
    chalcogens = atoms.where(F.col("element").isin(*vocab.CLUSTER_CHALCOGENS)).selectExpr(
        "component_id", "atom_id AS from_atom"
    )
    metals = atoms.where(F.col("element").isin(*vocab.CLUSTER_METALS)).selectExpr(
        "component_id", "atom_id AS to_atom"
    )
    return (
        edges.join(chalcogens, ["component_id", "from_atom"])
        .join(metals, ["component_id", "to_atom"])
        .groupBy("component_id", "from_atom")
        .agg(F.count(F.lit(1)).alias("metals"))
        .where(F.col("metals") >= 2)
        .select("component_id")
        .distinct()
    )


def heme_prefilter(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """Components that could be hemes: one Fe, three Fe-N bonds, enough C and N."""
    counted = atoms.groupBy("component_id").agg(
        F.count_if(F.col("element") == "FE").alias("iron"),
        F.count_if(F.col("element") == "C").alias("carbon"),
        F.count_if(F.col("element") == "N").alias("nitrogen"),
    ).where(
        (F.col("iron") == 1)
        & (F.col("carbon") >= vocab.CORE_MIN_CARBON)
        & (F.col("nitrogen") >= vocab.CORE_MIN_NITROGEN)
    )
    iron = atoms.where(F.col("element") == "FE").selectExpr("component_id", "atom_id AS from_atom")
    nitrogen = atoms.where(F.col("element") == "N").selectExpr("component_id", "atom_id AS to_atom")
    bonded = (
        both_ways(bonds.join(counted, "component_id", "left_semi"))
        .join(iron, ["component_id", "from_atom"])
        .join(nitrogen, ["component_id", "to_atom"])
        .groupBy("component_id")
        .agg(F.count(F.lit(1)).alias("donors"))
        .where(F.col("donors") >= vocab.CORE_MIN_IRON_NITROGEN_BONDS)
    )
    return bonded.select("component_id")


def _two_connected_blocks(edges: list[tuple[str, str]]) -> list[set[str]]:
    """Vertex sets of the two-connected blocks of a small graph, by low-link search."""
    neighbours: dict[str, list[str]] = {}
    for a, b in edges:
        neighbours.setdefault(a, []).append(b)
        neighbours.setdefault(b, []).append(a)
    order: dict[str, int] = {}
    low: dict[str, int] = {}
    blocks: list[set[str]] = []
    for root in neighbours:
        if root in order:
            continue
        order[root] = low[root] = len(order)
        path: list[tuple[str, str]] = []
        frames = [(root, "", iter(neighbours[root]))]
        while frames:
            node, parent, rest = frames[-1]
            child = next(rest, None)
            if child is None:
                frames.pop()
                if not frames:
                    continue
                low[parent] = min(low[parent], low[node])
                if low[node] >= order[parent]:
                    block: set[str] = set()
                    while path and path[-1] != (parent, node):
                        block.update(path.pop())
                    block.update(path.pop())
                    blocks.append(block)
            elif child not in order:
                path.append((node, child))
                order[child] = low[child] = len(order)
                frames.append((child, node, iter(neighbours[child])))
            elif child != parent and order[child] < order[node]:
                path.append((node, child))
                low[node] = min(low[node], order[child])
    return blocks


def _core_of(graph: pd.DataFrame) -> pd.DataFrame:
    """Whether one component's ligand holds a porphyrin-like core."""
    elements: dict[str, str] = {}
    edges, donors = set(), set()
    for row in graph.itertuples(index=False):
        elements[row.from_atom], elements[row.to_atom] = row.from_element, row.to_element
        ends = {row.from_element, row.to_element}
        if ends == {"FE", "N"}:
            donors.add(row.to_atom if row.to_element == "N" else row.from_atom)
        if not ends & {"H", *vocab.METALS}:
            edges.add(tuple(sorted((row.from_atom, row.to_atom))))
    found = any(
        len(block) >= vocab.CORE_MIN_ATOMS
        and sum(elements[a] == "C" for a in block) >= vocab.CORE_MIN_CARBON
        and sum(elements[a] == "N" for a in block) >= vocab.CORE_MIN_NITROGEN
        and len(block & donors) >= vocab.CORE_MIN_IRON_NITROGEN_BONDS
        for block in _two_connected_blocks(sorted(edges))
    )
    return pd.DataFrame({"component_id": graph["component_id"].iloc[:1], "is_heme": [found]})


def heme_components(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """Components with a heme core.

    Only components that pass the prefilter reach the graph search; each is one
    chemical component, a few hundred atoms at most.
    """
    wanted = heme_prefilter(atoms, bonds)
    ends = atoms.select("component_id", "atom_id", "element")
    graph = (
        both_ways(bonds.join(wanted, "component_id", "left_semi")).where("from_atom < to_atom")
        .join(ends.selectExpr("component_id", "atom_id AS from_atom", "element AS from_element"),
              ["component_id", "from_atom"])
        .join(ends.selectExpr("component_id", "atom_id AS to_atom", "element AS to_element"),
              ["component_id", "to_atom"])
        .select("component_id", "from_atom", "to_atom", "from_element", "to_element")
    )
    judged = graph.groupBy("component_id").applyInPandas(
        _core_of, "component_id string, is_heme boolean"
    )
    return judged.where("is_heme").select("component_id")


def build_catalog(components: DataFrame, atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """The catalog: metal-bearing components that are not single ions, with their class.

    ``components`` holds ``component_id, formula``. A cluster outranks a heme.
    """
    made_of = atoms.groupBy("component_id").agg(
        F.count(F.lit(1)).alias("n_atoms"),
        F.bool_or(F.col("element").isin(*vocab.METALS)).alias("holds_metal"),
    )
    formula = F.coalesce("formula", F.lit(""))
    unknown = formula.isin("", "?")
    judged = components.join(made_of, "component_id", "left").where(
        ~((F.coalesce("n_atoms", F.lit(0)) == 1) & F.coalesce("holds_metal", F.lit(False)))
        & (F.col("component_id") != "UNL")
        & F.when(unknown, F.coalesce("holds_metal", F.lit(False))).otherwise(formula_has_metal("formula"))
    )
    clusters = cluster_components(atoms, bonds).withColumn("is_cluster", F.lit(True))
    hemes = heme_components(atoms, bonds).withColumn("is_heme", F.lit(True))
    return judged.join(clusters, "component_id", "left").join(hemes, "component_id", "left").select(
        "component_id",
        F.when(formula == "", F.lit("?")).otherwise(formula).alias("formula"),
        F.when(F.col("is_cluster"), F.lit("cluster"))
        .when(F.col("is_heme"), F.lit("heme"))
        .otherwise(F.lit(""))
        .alias("structural_class"),
    )


def canonical_conflicts(catalog: DataFrame) -> DataFrame:
    """Reference cofactors whose class is not what the method names."""
    spark = catalog.sparkSession
    rows = [(c, "heme") for c in vocab.CANONICAL_HEMES] + [(c, "cluster") for c in vocab.CANONICAL_CLUSTERS]
    expected = spark.createDataFrame(rows, "component_id string, expected string")
    return expected.join(catalog, "component_id", "left").where(
        ~F.col("expected").eqNullSafe(F.col("structural_class"))
    ).select("component_id", "expected", F.coalesce("structural_class", F.lit("<absent>")).alias("found"))
