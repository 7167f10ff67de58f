"""Declared connections resolved to atoms of the analysed model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import first_label, labels
from sitegrade.functions.geometry import distance, fractionalize, image_provenance
from sitegrade.operators.contacts import ATOM_COLUMNS
from sitegrade.operators.inventory import record_order, with_selected_altloc
from sitegrade.session import cut_lineage

RESIDUE = ("entry_id", "chain_index", "residue_index")


def unique_connection_ids(connections: DataFrame) -> DataFrame:
    """Give repeated ids of an entry a suffix of their position, the first stays.

    A blank id becomes ``<source>_<position>``. A new id ends with its own position,
    so it can only meet an id that was given in that form; where there are such ids,
    passes repeat over them until none is left twice. The connections leave dealt by
    entry, are moved only if they were not, and are not stored.
    """
    stated = F.trim(F.coalesce("connection_id", F.lit("")))
    formed = (stated == "") | stated.rlike("_-?[0-9]+$")
    name = F.when(stated == "", F.concat_ws("_", "source", "position")).otherwise(stated)
    rivals = cut_lineage(
        connections.where(formed).select("entry_id", name.alias("connection_id")).distinct())
    # by entry alone, so that connections made inside entries are not dealt again
    same = Window.partitionBy("entry_id").orderBy("connection_id").rangeBetween(
        Window.currentRow, Window.currentRow)
    named = connections.withColumn("connection_id", name).withColumn("__first", F.min("position").over(same))
    named = _suffixed(named).drop("__first")
    if rivals.isEmpty():
        return named
    while True:
        repeated = cut_lineage(
            named.join(rivals, ["entry_id", "connection_id"], "left_semi").groupBy("entry_id", "connection_id").agg(
                F.min("position").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n"))
        if repeated.isEmpty():
            return named
        named = _suffixed(named.join(repeated, ["entry_id", "connection_id"], "left")).drop("__first")


def _suffixed(named: DataFrame) -> DataFrame:
    """Ids of rows after the ``__first`` of their id, with their position as suffix."""
    return named.withColumn(
        "connection_id",
        F.when(F.col("position") > F.col("__first"), F.concat_ws("_", "connection_id", "position"))
        .otherwise(F.col("connection_id")))


def _residue_index(atoms: DataFrame) -> DataFrame:
    """Author identities that name exactly one residue."""
    residues = atoms.select(*RESIDUE, "chain_id", "residue_name", "resnum").distinct()
    return residues.groupBy("entry_id", "chain_id", "residue_name", "resnum").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("chain_index").alias("chain_index"),
        F.min("residue_index").alias("residue_index"),
    ).where("n = 1").drop("n")


ADDRESS = ("entry_id", "chain_id", "residue_name", "resnum", "atom_name", "wanted_altloc")


def _addresses(
    source: DataFrame, contact: DataFrame | None, selections: DataFrame | None, renames: DataFrame | None,
    dealt: bool = False,
) -> DataFrame:
    """What every address of an atom answers: one row per atom and stated conformer.

    Carries the keys of ``ADDRESS``, the declared record (``declared_index``,
    ``element``) and ``atom``, the modelled atom of the same name and element.
    Grows with the atoms, not with the connections that name them. Without
    ``contact`` and ``selections`` both are settled here, inside entries: the
    records are dealt by entry once (``dealt``: they are already), and so are the addresses.
    """
    inside = contact is None and renames is None
    index = None if inside else _residue_index(source)
    if renames is not None:
        author = ["entry_id", "chain_id", "residue_name", "resnum"]
        alias = index.withColumnRenamed("chain_id", "new_chain").join(
            renames.select("entry_id", "chain_id", "new_chain"), ["entry_id", "new_chain"])
        index = index.unionByName(
            alias.select(*index.columns).join(index.select(*author), author, "left_anti"))
    whole = F.struct(*[F.col(c) for c in ATOM_COLUMNS], F.col("polymer_position"))
    named = Window.partitionBy(*RESIDUE, "atom_name")
    label = F.coalesce("altloc", F.lit(""))
    if contact is None:
        eligible = F.coalesce((F.col("altloc") == "") | (F.col("altloc") == F.col("selected_altloc")), F.lit(False))
        best = named.orderBy(~eligible, F.col("altloc") == "", *record_order())
        records = source if dealt else source.repartition("entry_id")
        if inside:
            author = Window.partitionBy("entry_id", "chain_id", "residue_name", "resnum")
            at = F.struct("chain_index", "residue_index")
            alone = F.min(at).over(author).eqNullSafe(F.max(at).over(author))
            identity = F.when(F.col("__alone"), F.struct("chain_id", "residue_name", "resnum"))
            records = records.withColumn("__alone", alone).withColumn(
                "__authors", F.collect_set(identity).over(Window.partitionBy(*RESIDUE)))
        records = with_selected_altloc(records, RESIDUE).withColumn(
            "modelled", F.first(F.when(eligible, whole)).over(best)).withColumn("altloc", label)
    else:
        records = source.withColumn("altloc", label).join(
            selections.select(*RESIDUE, "selected_altloc"), list(RESIDUE), "left"
        ).join(contact.select(*RESIDUE, "atom_name", whole.alias("modelled")), [*RESIDUE, "atom_name"], "left")
    # Without a stated conformer the selected one answers, else the first in file order.
    conformer = Window.partitionBy(*RESIDUE, "atom_name", "altloc")
    placed = records.withColumns({
        "__place": F.row_number().over(named.orderBy(F.col("altloc") != F.col("selected_altloc"), "source_order")),
        "__own": F.row_number().over(conformer.orderBy("source_order")),
    })
    answers = F.array(
        F.when(F.col("__place") == 1, F.lit("")),
        F.when((F.col("__own") == 1) & (F.col("altloc") != ""), F.col("altloc")))
    same = F.col("modelled.element").eqNullSafe(F.col("element"))
    found = placed.where("__place = 1 OR __own = 1").select(
        *RESIDUE, *(["__authors"] if inside else []), "atom_name",
        F.col("atom_index").alias("declared_index"), "element", F.when(same, F.col("modelled")).alias("atom"),
        F.explode(F.filter(answers, lambda a: a.isNotNull())).alias("wanted_altloc"),
    )
    named_by = found.select("*", F.inline("__authors")) if inside else found.join(index, list(RESIDUE))
    return named_by.select(*ADDRESS, "declared_index", "element", "atom")


def resolve_partner(
    connections: DataFrame,
    side: str,
    source: DataFrame,
    contact: DataFrame,
    selections: DataFrame,
    renames: DataFrame | None = None,
) -> DataFrame:
    """Resolve one partner of every connection.

    ``side`` is ``p1`` or ``p2``; its address columns are ``<side>_chain``,
    ``_resname``, ``_resnum``, ``_atom``, ``_altloc``. An address must name
    exactly one residue; if it does not, the chain's new name is tried. Adds
    ``<side>``: the atom of the selected conformer (null when unresolved), and
    ``<side>_found``, ``_substituted``, ``_metal_evidence``.
    """
    return _resolved(connections, side, _addresses(source, contact, selections, renames))


def resolve_partners(
    connections: DataFrame,
    source: DataFrame,
    renames: DataFrame | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Both partners of every connection, by :func:`resolve_partner`'s rules.

    Conformers and modelled atoms are those ``contact_atoms`` selects from
    ``source``; each side is one join with the table of addresses. Connections
    dealt by entry, as :func:`unique_connection_ids` leaves them, meet the
    addresses where they are. ``dealt``: so is ``source``.
    """
    addresses = _addresses(source, None, None, renames, dealt)
    return _resolved(_resolved(connections, "p1", addresses), "p2", addresses)


def _resolved(connections: DataFrame, side: str, addresses: DataFrame) -> DataFrame:
    a = lambda part: F.col(f"{side}_{part}")
    stated = connections.withColumns({
        "chain_id": a("chain"), "residue_name": F.upper(F.trim(a("resname"))), "resnum": a("resnum"),
        "atom_name": F.trim(a("atom")), "wanted_altloc": F.coalesce(a("altloc"), F.lit("")),
    })
    evidence = (F.col("declared_index").isNotNull() & F.col("element").isin(*vocab.METALS)) | (
        F.col("residue_name").isin(*vocab.METALS)
        & ~F.col("residue_name").isin(*vocab.AMBIGUOUS_METAL_COMPONENTS)
    )
    return stated.join(addresses, list(ADDRESS), "left").select(
        *[F.col(c) for c in connections.columns],
        F.col("atom").alias(side),
        F.col("declared_index").isNotNull().alias(f"{side}_found"),
        F.coalesce(
            F.col("atom").isNotNull() & (F.col("atom.atom_index") != F.col("declared_index")), F.lit(False)
        ).alias(f"{side}_substituted"),
        F.coalesce(evidence, F.lit(False)).alias(f"{side}_metal_evidence"),
    )


def _selected_metal(side: str) -> Column:
    element, occupancy = F.col(f"{side}.element"), F.col(f"{side}.occupancy")
    absent = F.col(f"{side}.occupancy_valid") & (occupancy == 0)
    return F.coalesce(element.isin(*vocab.METALS) & ~F.coalesce(absent, F.lit(False)), F.lit(False))


def declared_outcomes(resolved: DataFrame) -> DataFrame:
    """Issue, warnings and the oriented (metal, neighbour) pair of each connection.

    ``resolved`` went through :func:`resolve_partner` for both sides. Exactly
    one partner must be a selected metal. A connection unrelated to metals
    leaves no trace.
    """
    first, second = _selected_metal("p1"), _selected_metal("p2")
    evidence = F.col("p1_metal_evidence") | F.col("p2_metal_evidence")
    flagged = resolved.withColumns(
        {
            "first_metal": first,
            "second_metal": second,
            "evidence": evidence,
            "involves_metal": evidence | first | second,
            "deselected": (F.col("p1_found") & F.col("p1").isNull())
            | (F.col("p2_found") & F.col("p2").isNull()),
            "substituted": F.col("p1_substituted") | F.col("p2_substituted"),
        }
    ).withColumns(
        {
            "metal": F.when(F.col("first_metal"), F.col("p1")).otherwise(F.col("p2")),
            "neighbor": F.when(F.col("first_metal"), F.col("p2")).otherwise(F.col("p1")),
        }
    )
    lost_one = F.col("p1").isNull() | F.col("p2").isNull()
    lost_both = F.col("p1").isNull() & F.col("p2").isNull()
    paired = ~lost_one & (F.col("first_metal") != F.col("second_metal"))

    def placed(side: str) -> Column:
        return (
            F.col(f"{side}.x").isNotNull() & F.col(f"{side}.y").isNotNull()
            & F.col(f"{side}.z").isNotNull()
        )

    finite = placed("metal") & placed("neighbor")
    donor = F.coalesce(F.col("neighbor.element").isin(*vocab.DONOR_ELEMENTS), F.lit(False))
    own = (F.col("metal.chain_index") == F.col("neighbor.chain_index")) & (
        F.col("metal.residue_index") == F.col("neighbor.residue_index")
    )
    outcome = first_label(
        [
            (F.col("deselected") & F.col("evidence"), "conformer_deselected"),
            (F.col("deselected"), "ignored"),
            (lost_one & ~F.col("involves_metal"), "ignored"),
            (lost_both, "neither_resolved"),
            (lost_one, "unresolved"),
            (~paired, "ignored"),
            (~finite, "non_finite"),
            (~donor, "unsupported_element"),
            (own, "own_residue"),
        ],
        "candidate",
    )
    decided = flagged.withColumn("outcome", outcome)
    is_candidate = F.col("outcome") == "candidate"
    traced = F.col("outcome").isin(
        "candidate", "conformer_deselected", "neither_resolved", "unresolved", "non_finite"
    )
    label = F.concat_ws(" ", "source", "connection_id")
    issue = (
        F.when(F.col("outcome") == "conformer_deselected",
               F.concat(label, F.lit(" partner names a conformer whose selected alternative has no matching atom")))
        .when(F.col("outcome") == "neither_resolved", F.concat(label, F.lit(" neither partner resolved")))
        .when(F.col("outcome") == "unresolved", F.concat(label, F.lit(" partner unresolved")))
        .when(F.col("outcome") == "non_finite",
              F.concat(label, F.lit(" geometry unavailable: partner has non-finite coordinates")))
    )
    return decided.withColumns(
        {
            "issue": issue,
            "donor_class_supported": _supported_class(),
            "warnings": _warnings(traced, is_candidate),
        }
    )


def _supported_class() -> Column:
    """Whether the neighbour's residue class has reference distances."""
    named = F.col("neighbor.is_water") | F.col("neighbor.residue_name").isin(*vocab.AMINO_ACIDS)
    return F.coalesce(named, F.lit(False))


def _warnings(traced: Column, usable: Column) -> Column:
    """Warnings of a declaration that leaves a trace, and of one that is a candidate."""
    zero = F.col("neighbor.occupancy_valid") & (F.col("neighbor.occupancy") == 0)
    return labels(
        [
            (traced & F.col("substituted") & F.col("involves_metal"),
             "declared_connection_conformer_substituted"),
            (usable & F.coalesce(zero, F.lit(False)), "declared_connection_zero_occupancy_partner"),
            (F.col("outcome") == "unsupported_element", "declared_donor_element_unsupported"),
            (usable & ~_supported_class(), "declared_donor_outside_supported_classes"),
        ]
    )


def _pair_columns() -> list[Column]:
    """Candidate columns (``m_``, ``n_``, provenance) of a resolved declaration."""
    reported = F.when(F.col("reported_distance") > 0, F.col("reported_distance"))
    record = F.struct(
        "source", "connection_id", F.lower("connection_type").alias("connection_type"),
        F.trim("link_id").alias("link_id"), F.lower("asu").alias("asu"),
        reported.alias("reported_distance"),
    )
    return [
        F.col("entry_id"),
        *[F.col(f"metal.{c}").alias(f"m_{c}") for c in ATOM_COLUMNS],
        *[F.col(f"neighbor.{c}").alias(f"n_{c}") for c in (*ATOM_COLUMNS, "polymer_position")],
        F.array("source").alias("sources"),
        F.array(record).alias("declared"),
        F.col("donor_class_supported"),
        F.lower("asu").alias("asu"),
    ]


def declared_pairs(outcomes: DataFrame) -> DataFrame:
    """Candidate rows (``m_``, ``n_``, provenance) of the usable declarations.

    Geometry is added by ``as_explicit`` for pairs in one asymmetric unit;
    :func:`place_declared` also finds the image of pairs in different ones.
    """
    return outcomes.where(F.col("outcome") == "candidate").select(*_pair_columns())


def image_frames(cells: DataFrame, operations: DataFrame) -> DataFrame:
    """One row per entry with a cell and operations: matrix, crystal operations counted, all as an array.

    An entry has few operations, which its space group and its NCS set bound.
    """
    matrix = cells.select("entry_id", "m11", "m12", "m13", "m22", "m23", "m33").dropDuplicates(["entry_id"])
    turns = [f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)]
    sets = operations.groupBy("entry_id").agg(
        F.count_if(~F.col("is_ncs")).cast("int").alias("operation_count"),
        F.collect_list(F.struct("image_index", *turns, "t1", "t2", "t3")).alias("operations"))
    return matrix.join(sets, "entry_id")


def with_nearest_image(pairs: DataFrame) -> DataFrame:
    """Add the nearest image of each pair's second point around its first one.

    ``pairs`` carries the columns of :func:`image_frames`, ``m_x, m_y, m_z``,
    ``n_x, n_y, n_z``, ``sought``, whether an image is looked for, and ``elsewhere``:
    whether the deposited position itself is no answer. Each operation comes with the
    whole-cell shift that brings the points within half a cell of one another
    along every axis. Equal distances, up to arithmetic noise, go to the lower
    operation. Adds ``image_index, tx, ty, tz`` and the image's position
    ``px, py, pz``, null for pairs without any image. A row is settled by itself.
    """
    sides = [F.col(f"{s}_{a}") for s in "mn" for a in "xyz"]
    axes = (("1", "u", "x"), ("2", "v", "y"), ("3", "w", "z"))
    pointed = pairs.withColumns(dict(zip(
        ("__lu", "__lv", "__lw", "__ru", "__rv", "__rw"),
        (*fractionalize(*sides[:3]), *fractionalize(*sides[3:])), strict=True)))
    turned = ", ".join(f"o.r{i}1 * __ru + o.r{i}2 * __rv + o.r{i}3 * __rw + o.t{i} AS g{u}" for i, u, _ in axes)
    shifted = ", ".join(f"CAST(round(__l{u} - o.g{u}) AS INT) AS t{a}" for _, u, a in axes)
    inside = ", ".join(f"o.g{u} + o.t{a} AS i{u}" for _, u, a in axes)
    shift = "o.tx AS tx, o.ty AS ty, o.tz AS tz"
    spot = ("m11 * o.iu + m12 * o.iv + m13 * o.iw AS px, m22 * o.iv + m23 * o.iw AS py, m33 * o.iw AS pz")
    gap = "sqrt(0.0D + (m_x - o.px) * (m_x - o.px) + (m_y - o.py) * (m_y - o.py) + (m_z - o.pz) * (m_z - o.pz))"
    kept = "o.image_index AS image_index"
    met = "CASE WHEN sought AND operation_count > 0 THEN operations END"
    for made in (
        f"{kept}, {turned}", f"{kept}, o.gu AS gu, o.gv AS gv, o.gw AS gw, {shifted}",
        f"{kept}, {shift}, {inside}", f"{kept}, {shift}, {spot}",
    ):
        met = f"transform({met}, o -> struct({made}))"
    met = (f"filter({met}, o -> NOT (elsewhere AND o.image_index = 0 AND o.tx = 0 AND o.ty = 0 AND o.tz = 0))")
    # equal up to arithmetic noise counts as equal
    best = (f"array_min(transform({met}, o -> struct(floor({gap} * 1e6D + 0.5D) AS gap, {kept}, {shift},"
            " o.px AS px, o.py AS py, o.pz AS pz)))")
    return pointed.selectExpr(*pairs.columns, f"{best} AS __image").select(
        *pairs.columns, *[F.col(f"__image.{c}").alias(c) for c in ("image_index", "tx", "ty", "tz", "px", "py", "pz")])


def place_declared(
    outcomes: DataFrame, cells: DataFrame | None = None, operations: DataFrame | None = None
) -> DataFrame:
    """Declarations whose partners resolved, at the image they name.

    ``outcomes`` comes from :func:`declared_outcomes`. A declaration in the
    ``same`` asymmetric unit keeps the deposited positions, one in a
    ``different`` unit takes the nearest other image, any other statement the
    nearest image of all. Images are searched in entries with a cell and
    operations; elsewhere ``different`` cannot be placed, and the rest keep the
    deposited positions. A neighbour in the metal's own residue counts only at
    a generated image.

    Adds to the candidate columns of :func:`declared_pairs` ``position``, the
    geometry and image columns, ``placement`` (``placed``, ``own_residue`` or
    ``unplaced``), and the final ``issue`` and ``warnings``.
    """
    usable = outcomes.where(F.col("outcome").isin("candidate", "own_residue"))
    stated = F.lower(F.trim(F.coalesce("asu", F.lit(""))))
    kept = usable.select(
        "position", F.concat_ws(" ", "source", "connection_id").alias("label"),
        _warnings(F.lit(True), F.lit(True)).alias("warnings"),
        _warnings(F.lit(True), F.lit(False)).alias("substitution"),
        *_pair_columns(), stated.alias("stated"))
    if cells is None or operations is None:
        joined = kept.withColumns({
            "searched": F.lit(False), **{c: F.lit(None).cast("int") for c in ("image_index", "tx", "ty", "tz")},
            **{c: F.lit(None).cast("double") for c in ("px", "py", "pz")},
            "operation_count": F.lit(None).cast("int")})
    else:
        frames = image_frames(cells, operations)
        framed = kept.join(frames, "entry_id", "left").withColumns({
            "searched": F.col("operations").isNotNull(), "sought": F.col("stated") != "same",
            "elsewhere": F.col("stated") == "different"})
        joined = with_nearest_image(framed).drop(
            "sought", "elsewhere", "operations", *[c for c in frames.columns if c.startswith("m")])
    generated = F.col("image_index").isNotNull() & (
        (F.col("image_index") != 0) | (F.col("tx") != 0) | (F.col("ty") != 0) | (F.col("tz") != 0))
    own = (F.col("m_chain_index") == F.col("n_chain_index")) & (
        F.col("m_residue_index") == F.col("n_residue_index"))
    found = joined.withColumn("generated", generated).withColumn("placement", first_label(
        [
            ((F.col("stated") == "different") & ~F.col("generated"), "unplaced"),
            (own & ~F.col("generated"), "own_residue"),
        ], "placed"))
    # a pair at its deposited positions keeps them exactly
    index = F.when(F.col("generated"), F.col("image_index")).otherwise(0)
    shift = {c: F.when(F.col("generated"), F.col(c)).otherwise(0) for c in ("tx", "ty", "tz")}
    spot = {f"p{a}": F.when(F.col("generated"), F.col(f"p{a}")).otherwise(F.col(f"n_{a}")) for a in "xyz"}
    placed = found.withColumns({
        "image_index": index, **shift, **spot, "operation_count": F.coalesce("operation_count", F.lit(1))})
    reason = F.when(F.col("searched"), F.lit("no image in a different unit")).otherwise(
        F.lit("symmetry metadata unavailable"))
    lost = F.col("placement") == "unplaced"
    none = F.array().cast("array<string>")
    return placed.withColumns({
        "distance": distance(tuple(F.col(f"m_{a}") for a in "xyz"), tuple(F.col(f"p{a}") for a in "xyz")),
        **image_provenance("image_index", ("tx", "ty", "tz"), "operation_count"),
        "issue": F.when(lost, F.concat("label", F.lit(" geometry unresolved: "), reason)),
        "warnings": F.when(lost, F.col("substitution"))
        .when(F.col("placement") == "own_residue", none).otherwise(F.col("warnings")),
    }).drop("label", "substitution", "stated", "searched", "generated", "operation_count")


# ---- residues and polymers -----------------------------------------------------
def restore_identity(residues: DataFrame, mapping: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Author identity of renamed residues; ``packed`` marks those that changed.

    ``mapping`` maps the coordinate identity in ``keys`` to ``source_<key>``.
    """
    joined = residues.join(mapping, list(keys), "left")
    changed = F.lit(False)
    for key in keys:
        changed = changed | (
            F.col(f"source_{key}").isNotNull() & (F.col(f"source_{key}") != F.col(key))
        )
    return joined.select(
        *[c for c in residues.columns if c not in keys],
        *[F.col(k).alias(f"coordinate_{k}") for k in keys],
        *[F.coalesce(F.col(f"source_{k}"), F.col(k)).alias(k) for k in keys],
        changed.alias("packed"),
    )


def polymer_position(is_polymer: Column, label_seq: Column, length: Column) -> Column:
    """N, C, NC or M from the position in the declared sequence; ? without one."""
    known = label_seq.isNotNull() & length.isNotNull() & label_seq.between(F.lit(1), length)
    first, last = label_seq == 1, label_seq == length
    return first_label(
        [
            (~is_polymer, "-"), (~F.coalesce(known, F.lit(False)), "?"),
            (first & last, "NC"), (first, "N"), (last, "C"),
        ],
        "M",
    )


def modeled_termini(residues: DataFrame, sequences: DataFrame, chain: tuple[str, ...]) -> DataFrame:
    """First and last modelled residues of chains that model their whole sequence.

    ``residues`` carries ``position`` (1-based rank in its chain) and ``name``;
    ``sequences`` the declared ``position`` and ``name``. A chain counts only
    when both sides agree in every position.
    """
    sides = residues.select(*chain, "position", "name", F.lit(1).alias("modeled")).join(
        sequences.select(*chain, "position", F.col("name").alias("declared_name")),
        [*chain, "position"], "full_outer",
    )
    complete = sides.groupBy(*chain).agg(
        F.bool_and(F.coalesce(F.col("name") == F.col("declared_name"), F.lit(False))).alias("complete"),
        F.max("position").alias("length"),
    )
    return residues.join(complete, list(chain)).where(
        F.col("complete") & ((F.col("position") == 1) | (F.col("position") == F.col("length")))
    ).select(
        *chain, "position",
        (F.col("position") == 1).alias("is_first"),
        (F.col("position") == F.col("length")).alias("is_last"),
    )


def match_records(left: DataFrame, right: DataFrame, identity: list[str], serial: str) -> DataFrame:
    """Match two record sets by identity, then serial, then order; both may have leftovers.

    Within an identity equal serials pair first, one to one where a serial
    repeats; the rest pair in serial order.
    Returns the serials as ``left_serial`` and ``right_serial``, one null for a
    record without a partner.
    """
    from sitegrade.operators.prefix import ordinal_within

    l_side = left.select(*identity, F.col(serial).alias("left_serial"))
    r_side = right.select(*identity, F.col(serial).alias("right_serial"))
    l_side, r_side = (
        side.withColumn("nth", F.row_number().over(
            Window.partitionBy(*identity, name).orderBy(name)))
        for side, name in ((l_side, "left_serial"), (r_side, "right_serial")))
    both = l_side.join(r_side.withColumn("left_serial", F.col("right_serial")),
                       [*identity, "left_serial", "nth"])
    exact = both.select(*identity, "left_serial", "right_serial")
    paired = both.select(*identity, "left_serial", "nth")
    spare_left = l_side.join(paired, [*identity, "left_serial", "nth"], "left_anti").drop("nth")
    spare_right = r_side.join(
        paired.withColumnRenamed("left_serial", "right_serial"),
        [*identity, "right_serial", "nth"], "left_anti").drop("nth")
    ranked_left = ordinal_within(spare_left, identity, "left_serial", "place")
    ranked_right = ordinal_within(spare_right, identity, "right_serial", "place")
    return exact.unionByName(
        ranked_left.join(ranked_right, [*identity, "place"], "full_outer").drop("place")
    )
