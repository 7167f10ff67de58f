"""Text mining of crystallization conditions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrade import vocab
from sitegrade.functions.clean import as_col

# Patterns (fixed formats). ``(?U)`` makes word boundaries see every letter.
MASS_UNIT = r"(?U)(?<![A-Za-z])(?:MG|Mg)\s*/\s*(?:[MDUmdu]|µ)?L\b|\d[\d.]*\s*MG\b"
PH_SINGLE = r"(?iU)\bp\s*h\s*(?:=|:)?\s*(-?\d+(?:\.\d+)?)"
PH_RANGE = (
    r"(?iU)\bp\s*h\s*(?:range)?\s*(?:=|:)?\s*(-?\d+(?:\.\d+)?)\s*[-–]\s*"
    r"(-?\d+(?:\.\d+)?)(?![\d.]*\s*%)"
)
TEMPERATURE = (
    r"(?iU)\b(?:temperature|temp\.?)\s*(?:=|:)?\s*(\d+(?:\.\d+)?)\s*"
    r"(?:(k\b|kelvin\b)"
    r"|((?:deg(?:rees?)?\.?\s*|°\s*)?(?:c\b|celsius\b|centigrade\b)))?"
)


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _any_of(words: list[str]) -> str:
    """A pattern of many words that shares their prefixes, so a miss fails early."""
    tails: dict[str, list[str]] = {}
    for word in words:
        if word:
            tails.setdefault(word[0], []).append(word[1:])
    if not tails:
        return ""
    parts = [re.escape(first) + _any_of(rest) for first, rest in sorted(tails.items())]
    body = parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
    return f"(?:{body})?" if "" in words else body


def _spelled(symbols: list[str], *, title: bool = True, upper: bool = True) -> str:
    """Symbols in title case, upper case or both."""
    forms = [s.title() for s in symbols if title] + [s for s in symbols if upper]
    return _any_of(list(dict.fromkeys(forms)))


def _symbol_pattern(symbols: list[str], *, bare: bool) -> str:
    """Symbols inside formulas and salts, and standing alone when ``bare``.

    What follows a symbol is only looked at, so one token can name several
    metals, and no match hides the next.
    """
    letters = "".join(sorted({s[0] for s in symbols}))
    formula = r"(?=\d|[A-Z(][A-Za-z0-9()]*\d)"
    alone = r"|(?<=\b[A-Za-z]{2})\b(?!-[A-Za-z])" if bare else ""
    salts = [s for s in symbols if s in vocab.SALT_METALS]
    titled, uppered = _any_of(list(vocab.SALT_ANIONS)), _any_of([a.upper() for a in vocab.SALT_ANIONS])
    return (
        rf"(?U)(?<![A-Za-z])(?=[{letters}])((?:{_spelled(symbols)})(?:{formula}{alone})"
        rf"|(?:{_spelled(salts, upper=False)})(?={titled}(?![A-Za-z]))"
        rf"|(?:{_spelled(salts, title=False)})(?={uppered}(?![A-Za-z])))"
    )


def metals_in_text(text: str | Column) -> Column:
    """Sorted symbols of the metals a text names, by name, symbol, formula or salt.

    Three passes cover every metal: names as whole words in any case, two-letter
    symbols and one-letter symbols with their case. The two lengths stay apart
    because ``YB2`` names both yttrium and ytterbium.
    """
    cleaned = F.regexp_replace(as_col(text), MASS_UNIT, " ")
    names = {alias: symbol for symbol, group in vocab.METAL_NAMES.items() for alias in group}
    by_name = F.transform(
        _found(F.lower(cleaned), rf"(?U)\b({_any_of(list(names))})\b"),
        lambda hit: F.element_at(
            F.create_map(*[F.lit(part) for pair in names.items() for part in pair]), hit
        ),
    )
    two = [s for s in vocab.METAL_NAMES if len(s) == 2]
    one = [s for s in vocab.METAL_NAMES if len(s) == 1]
    by_symbol = F.concat(
        _found(cleaned, _symbol_pattern(two, bare=True)),
        _found(cleaned, _symbol_pattern(one, bare=False)),
    )
    symbols = F.transform(by_symbol, lambda hit: F.upper(hit))
    return F.array_sort(F.array_distinct(F.concat(by_name, symbols)))


def ph_range(text: str | Column) -> Column:
    """A stated pH range as ``low-high``, or blank."""
    t = as_col(text)
    low, high = F.regexp_extract(t, PH_RANGE, 1), F.regexp_extract(t, PH_RANGE, 2)
    return F.when(low != "", F.concat(low, F.lit("-"), high)).otherwise(F.lit(""))


def ph_value(text: str | Column) -> Column:
    """A stated single pH, or blank when a range is stated instead."""
    t = as_col(text)
    return F.when(F.regexp_extract(t, PH_RANGE, 1) == "", F.regexp_extract(t, PH_SINGLE, 1)).otherwise(
        F.lit("")
    )


def temperature_kelvin(text: str | Column) -> Column:
    """A stated temperature in kelvin, or blank.

    Celsius is converted; a bare number counts only where it must be kelvin.
    """
    t = as_col(text)
    value = F.regexp_extract(t, TEMPERATURE, 1)
    number = value.try_cast("double")
    low, high = vocab.UNITLESS_KELVIN
    return (
        F.when(value == "", F.lit(""))
        .when(
            F.regexp_extract(t, TEMPERATURE, 3) != "",
            (value.try_cast("decimal(20,6)") + F.lit("273.15").cast("decimal(20,6)"))
            .cast("decimal(20,2)")
            .cast("string"),
        )
        .when((F.regexp_extract(t, TEMPERATURE, 2) != "") | number.between(low, high), value)
        .otherwise(F.lit(""))
    )


def method_keyword(text: str | Column) -> Column:
    """The first known method label a text contains, or blank."""
    lowered = F.lower(as_col(text))
    return F.coalesce(
        *[F.when(lowered.contains(label), F.lit(label)) for label in vocab.METHOD_LABELS],
        F.lit(""),
    )


def ingredient_flags(text: str | Column) -> dict[str, Column]:
    """Whether a text mentions sulfate, cacodylate or acetate."""
    lowered = F.lower(as_col(text))
    return {
        "sulfate": lowered.contains("sulfate") | lowered.contains("sulphate"),
        "cacodylate": lowered.contains("cacodylate"),
        "acetate": lowered.contains("acetate"),
    }


def metal_class_flags(metals: str | Column) -> dict[str, Column]:
    """Which metal classes a set of symbols touches."""
    found = as_col(metals)

    def touches(symbols: tuple[str, ...]) -> Column:
        return F.arrays_overlap(found, F.array(*[F.lit(s) for s in symbols]))

    return {
        "any_metal": F.size(found) > 0,
        "promiscuous_transition_metal": touches(vocab.PROMISCUOUS_METALS),
        "ni_co_like_metal": touches(vocab.NI_CO_METALS),
        "buffer_light_metal": touches(vocab.BUFFER_METALS),
        "heavy_additive_phasing_metal": touches(vocab.HEAVY_METALS),
    }


def remark_details(text: str | Column) -> Column:
    """Condition text of a coordinate file's REMARK 280 block, or blank."""
    lines = F.filter(
        F.split(as_col(text), r"\r?\n"), lambda line: line.startswith("REMARK 280")
    )
    pieces = F.filter(
        F.transform(lines, lambda line: F.trim(F.substring(line, F.lit(11), F.length(line)))),
        lambda piece: piece != "",
    )
    joined = F.array_join(pieces, " ")
    details = F.trim(
        F.regexp_extract(joined, r"(?is)CRYSTALLIZATION CONDITIONS\s*:\s*(.*)$", 1)
    )
    return F.when(F.upper(details) == "NULL", F.lit("")).otherwise(details)
