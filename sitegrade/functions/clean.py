"""Null, number, boolean and text cleaning. Missing values are null, never NaN."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed format: decimal text with an optional exponent.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
#: Cells that mean "no value" in coordinate records.
MISSING_TOKENS = ("", ".", "?", "\x00")
TRUE_TEXT = ("1", "true", "yes")
FALSE_TEXT = ("0", "false", "no")


def as_col(value: str | Column) -> Column:
    """A column from its name, or the column itself."""
    return F.col(value) if isinstance(value, str) else value


def finite(value: str | Column) -> Column:
    """A numeric column with NaN and the infinities turned into null."""
    x = as_col(value).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def finite_text(value: str | Column) -> Column:
    """A number parsed from text; blank, malformed or non-finite text is null."""
    text = as_col(value).cast("string")
    return finite(F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double")))


def lenient_bool(value: str | Column) -> Column:
    """True for ``1``/``true``/``yes`` in any case, false for everything else."""
    text = F.lower(F.trim(as_col(value).cast("string")))
    return F.coalesce(text.isin(*TRUE_TEXT), F.lit(False))


def strict_bool(value: str | Column, label: str) -> Column:
    """A boolean in any accepted spelling; anything else stops the job."""
    text = F.lower(F.trim(as_col(value).cast("string")))
    return (
        F.when(text.isin(*TRUE_TEXT), F.lit(True))
        .when(text.isin(*FALSE_TEXT), F.lit(False))
        .otherwise(
            F.raise_error(
                F.concat(F.lit(f"invalid boolean in {label}: "), F.coalesce(text, F.lit("null")))
            ).cast("boolean")
        )
    )


def tristate_bool(value: str | Column) -> Column:
    """A nullable boolean: unreadable text stays null."""
    text = F.lower(F.trim(as_col(value).cast("string")))
    return F.when(text.isin(*TRUE_TEXT), F.lit(True)).when(
        text.isin(*FALSE_TEXT), F.lit(False)
    )


def residue_name(value: str | Column) -> Column:
    """A component name in its canonical spelling: trimmed and upper case."""
    return F.upper(F.trim(as_col(value)))


def blank_if_missing(value: str | Column) -> Column:
    """Coordinate-record missing tokens become empty text."""
    text = as_col(value)
    return F.when(text.isNull() | F.trim(text).isin(*MISSING_TOKENS), F.lit("")).otherwise(text)


def clean_placeholder(value: str | Column) -> Column:
    """Trimmed text, with the ``.`` and ``?`` placeholders and null blanked."""
    text = F.trim(F.coalesce(as_col(value).cast("string"), F.lit("")))
    return F.when(text.isin(".", "?"), F.lit("")).otherwise(text)


def pipe_join(items: str | Column) -> Column:
    """An array as pipe-separated text, keeping blanks so lists stay aligned."""
    return F.array_join(
        F.transform(as_col(items), lambda v: F.coalesce(v.cast("string"), F.lit(""))), "|"
    )


def pipe_split(text: str | Column) -> Column:
    """Pipe-separated text as an array without blanks."""
    return F.filter(
        F.split(F.coalesce(as_col(text), F.lit("")), r"\|"), lambda v: v != F.lit("")
    )


def labels(pairs: Sequence[tuple[Column, str]]) -> Column:
    """The labels whose condition is true, in the order given."""
    flagged = F.array(*[F.when(condition, F.lit(label)) for condition, label in pairs])
    return F.filter(flagged, lambda v: v.isNotNull())


def first_label(pairs: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """The label of the first true condition: a decision table as one column."""
    head, *rest = pairs
    chain = F.when(head[0], F.lit(head[1]))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def ordered_union(*arrays: Column) -> Column:
    """Distinct items of several arrays in order of first appearance."""
    return F.array_distinct(F.concat(*arrays))


def is_subset(items: Column, known: Iterable[str]) -> Column:
    """Whether every item of an array belongs to a closed vocabulary."""
    return F.size(F.array_except(items, F.array(*[F.lit(k) for k in known]))) == 0


def text_array(values: Iterable[str]) -> Column:
    """A literal array of strings."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def bounded_list(items: Column, limit: int = 5) -> Column:
    """The first ``limit`` items joined by commas, plus a count of the rest."""
    shown = F.array_join(F.slice(items, 1, limit), ", ")
    rest = F.size(items) - F.lit(limit)
    return F.when(
        rest > 0, F.concat(shown, F.lit(" (and "), rest.cast("string"), F.lit(" more)"))
    ).otherwise(shown)
