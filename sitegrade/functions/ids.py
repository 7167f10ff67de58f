"""Identifiers and join keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrade.functions.clean import as_col

#: Fixed format: a four-character entry id.
ENTRY_ID_PATTERN = "^[A-Za-z0-9]{4}$"
UNIT_SEPARATOR = "\u001f"


def entry_id(value: str | Column) -> Column:
    """An entry id in its canonical spelling."""
    return F.lower(F.trim(as_col(value)))


def is_entry_id(value: str | Column) -> Column:
    """Whether text is a well-formed entry id."""
    return as_col(value).rlike(ENTRY_ID_PATTERN)


def entry_id_from_path(path: str | Column) -> Column:
    """The entry id a file name starts with, or null.

    The last extension is dropped first, as in ``1abc_final.cif``.
    """
    base = F.element_at(F.split(as_col(path), "/"), -1)
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    found = F.regexp_extract(stem, r"^([A-Za-z0-9]{4})(?:_.*)?$", 1)
    return F.when(found != "", F.lower(found))


def site_id(
    entry: str | Column,
    model: str | Column,
    chain: str | Column,
    residue: str | Column,
    atom: str | Column,
) -> Column:
    """``entry:m0:c1:r2:a3``, the stable id of one site."""
    return F.format_string(
        "%s:m%d:c%d:r%d:a%d",
        F.lower(as_col(entry)),
        *[as_col(part).cast("long") for part in (model, chain, residue, atom)],
    )


def contact_id(site: str | Column, parts: Sequence[str | Column]) -> Column:
    """The site id plus a 24-hex digest of the fields that name one image."""
    fields = [F.coalesce(as_col(part).cast("string"), F.lit("")) for part in parts]
    digest = F.sha2(F.concat_ws(UNIT_SEPARATOR, *fields), 256)
    return F.concat(as_col(site), F.lit(":c"), F.substring(digest, 1, 24))


def observation_id(
    entry: str | Column,
    model: str | Column,
    chain: str | Column,
    residue: str | Column,
    component: str | Column,
    row: str | Column,
) -> Column:
    """The id of one residue-level density observation."""
    chain_text = as_col(chain)
    shown = F.when(F.coalesce(chain_text, F.lit("")) == "", F.lit("_")).otherwise(chain_text)
    return F.concat_ws(
        "/",
        F.lower(as_col(entry)),
        F.concat(F.lit("model="), as_col(model).cast("string")),
        F.concat(F.lit("chain="), shown),
        F.concat(F.lit("residue="), as_col(residue).cast("string")),
        F.concat(F.lit("component="), as_col(component)),
        F.concat(F.lit("edstats_row="), as_col(row).cast("string")),
    )


def condition_id(entry: str | Column, ordinal: str | Column) -> Column:
    """``entry:condition:n``."""
    return F.concat(as_col(entry), F.lit(":condition:"), as_col(ordinal).cast("string"))


def site_key(
    entry: str | Column, site: str | Column, legacy: Sequence[str | Column]
) -> Column:
    """One text key per site: the site id, or the index columns without one."""
    text = [F.trim(F.coalesce(as_col(c).cast("string"), F.lit(""))) for c in legacy]
    named = F.trim(F.coalesce(as_col(site).cast("string"), F.lit("")))
    owner = F.trim(as_col(entry))
    return F.when(named != "", F.concat_ws(UNIT_SEPARATOR, owner, named)).otherwise(
        F.concat_ws(UNIT_SEPARATOR, owner, *text)
    )


def residue_sequence(value: str | Column) -> Column:
    """A four-column residue number: decimal, or hybrid-36 when it starts with a letter.

    Unreadable text is null. Ten thousand is the first hybrid-36 number, written
    ``A000``, which is 10 * 36**3 in plain base 36.
    """
    text = as_col(value)
    trimmed = F.trim(text)
    decimal = F.when(trimmed.rlike(r"^[+-]?\d{1,4}$"), trimmed.try_cast("int"))
    hybrid = F.when(
        F.upper(text).rlike("^[A-Z][0-9A-Z]{3}$"),
        F.conv(F.upper(text), 36, 10).try_cast("int") - F.lit(10 * 36**3) + F.lit(10_000),
    )
    return F.coalesce(decimal, hybrid)


def residue_id(value: str | Column) -> Column:
    """A residue number with its insertion code appended; null when unreadable.

    ``12:A`` and ``12A`` both read as number 12 with insertion code A.
    """
    text = F.trim(as_col(value))
    colon = F.instr(text, ":") > 0
    wide = F.length(text) > 4
    suffixed = text.rlike(r"^[^A-Za-z].*[A-Za-z]$")
    number = (
        F.when(colon, F.regexp_extract(text, r"^([^:]*):", 1))
        .when(wide, F.substring(text, 1, 4))
        .when(suffixed, F.expr("null").cast("string"))
        .otherwise(text)
    )
    number = F.coalesce(number, F.regexp_extract(text, r"^(.*)[A-Za-z]$", 1))
    insertion = (
        F.when(colon, F.regexp_extract(text, r"^[^:]*:(.*)$", 1))
        .when(wide, F.substring(text, 5, 1000))
        .when(suffixed, F.regexp_extract(text, r"([A-Za-z])$", 1))
        .otherwise(F.lit(""))
    )
    padded = F.lpad(number, 4, " ")
    decoded = F.when(F.length(number) <= 4, residue_sequence(padded))
    return F.when(
        decoded.isNotNull() & (F.length(insertion) <= 1),
        F.concat(decoded.cast("string"), insertion),
    )


def split_chain_conformer(value: str | Column) -> tuple[Column, Column, Column]:
    """Split ``A:B`` into chain and conformer; the third column marks bad labels."""
    text = F.coalesce(as_col(value), F.lit(""))
    has_colon = F.instr(text, ":") > 0
    head = F.when(has_colon, F.regexp_extract(text, r"^(.*):[^:]*$", 1)).otherwise(text)
    tail = F.when(has_colon, F.regexp_extract(text, r":([^:]*)$", 1)).otherwise(F.lit(""))
    missing = ("", ".", "?", "_")
    invalid = has_colon & (
        (F.instr(head, ":") > 0) | (F.length(tail) != 1) | tail.isin(*missing)
    )
    chain = F.when(head.isin(*missing), F.lit("")).otherwise(head)
    return chain, tail, invalid


def portable_path(prefix: str, *parts: str | Column) -> Column:
    """A source path relative to a named root."""
    return F.concat_ws("/", F.lit(prefix), *[as_col(p) for p in parts])


def policy_digest(prefix: str, payload: Column) -> Column:
    """``prefix`` plus twenty hex digits of a canonical JSON payload."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(payload, 256), 1, 20))


def symmetry_code(image_index: str | Column, shifts: Sequence[str | Column]) -> Column:
    """``1_555``: one-based operation and the lattice shift, five meaning none.

    A shift that leaves the single digits is written out, with separators.
    """
    parts = [as_col(s).cast("int") + 5 for s in shifts]
    plain = F.lit(True)
    for part in parts:
        plain = plain & part.between(F.lit(0), F.lit(9))
    texts = [part.cast("string") for part in parts]
    number = (as_col(image_index).cast("int") + 1).cast("string")
    return F.concat(
        number, F.lit("_"),
        F.when(plain, F.concat(*texts)).otherwise(F.concat_ws("_", *texts)),
    )
