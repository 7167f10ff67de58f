"""Decimal rounding of the exact binary value, ties to even.

Spark's ``round`` works on the shortest decimal text of a double, so 2.9995
(really 2.99949999...) becomes 3.0. Published scores and histogram keys are
rounded from the exact binary value instead. The product ``x * 10**places`` is
split into its rounded part and the exact remainder (Dekker's two-product), and
the remainder settles the cases where the rounded part lands on a half.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrade.functions.clean import as_col

_SPLITTER = 134217729.0  # 2**27 + 1


def _sql_double(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def _rounded_sql(x: str, product: str, high: str, places: int) -> str:
    """SQL text that settles ``x`` from its scaled product and its high part."""
    scale = float(10**places)
    shifted = _SPLITTER * scale
    s_high = shifted - (shifted - scale)
    low, part, rest = f"({x} - {high})", _sql_double(s_high), _sql_double(scale - s_high)
    error = (
        f"((({high} * {part} - {product}) + {high} * {rest}) + {low} * {part}) + {low} * {rest}"
    )
    whole, half = f"floor({product})", f"(({product} - floor({product})) - 0.5D)"
    up = (
        f"{half} > 0 OR ({half} = 0 AND (({error}) > 0"
        f" OR (({error}) = 0 AND abs(pmod({whole}, 2)) = 1)))"
    )
    # Past 2**52 / scale a double holds no digit beyond ``places``.
    return (
        f"CASE WHEN abs({x}) < {_sql_double(2.0**52 / scale)} THEN"
        f" (CAST({whole} AS DOUBLE) + CASE WHEN {up} THEN 1D ELSE 0D END)"
        f" / {_sql_double(scale)} ELSE {x} END"
    )


def with_rounded(
    df: DataFrame, columns: Mapping[str, tuple[str | Column, int]]
) -> DataFrame:
    """Add columns rounded from exact binary values: name -> (expression, places).

    The expression, its scaled product and its high part are columns of their
    own, so each is evaluated once however often the arithmetic refers to it.
    """
    kept = [c for c in df.columns if c not in columns]
    staged = df.select(
        *kept, *[as_col(e).cast("double").alias(f"__x_{n}") for n, (e, _) in columns.items()]
    )
    staged = staged.selectExpr(
        "*",
        *[
            part
            for n, (_, places) in columns.items()
            for part in (
                f"__x_{n} * {_sql_double(float(10**places))} AS __p_{n}",
                f"__x_{n} * {_SPLITTER!r}D - (__x_{n} * {_SPLITTER!r}D - __x_{n}) AS __h_{n}",
            )
        ],
    )
    rounded = {
        n: _rounded_sql(f"__x_{n}", f"__p_{n}", f"__h_{n}", places)
        for n, (_, places) in columns.items()
    }
    order = [*df.columns, *[n for n in columns if n not in df.columns]]
    return staged.selectExpr(
        *[f"{rounded[c]} AS `{c}`" if c in rounded else f"`{c}`" for c in order]
    )


def round_exact(name: str, places: int) -> Column:
    """A plain column rounded to ``places`` decimals from its exact binary value.

    For anything but a column name use :func:`with_rounded`: the arithmetic
    refers to its input many times.
    """
    x = f"CAST(`{name}` AS DOUBLE)"
    scaled = f"({x} * {_sql_double(float(10**places))})"
    high = f"({x} * {_SPLITTER!r}D - ({x} * {_SPLITTER!r}D - {x}))"
    return F.expr(_rounded_sql(x, scaled, high, places))


#: Decimal places of histogram keys, published scores and published metrics.
REFERENCE_PLACES = 3
SCORE_PLACES = 6
METRIC_PLACES = 12


def decimal_text(name: str, places: int = 6) -> Column:
    """A column as decimal text without trailing zeros; missing numbers are blank."""
    x = F.col(name)
    text = F.format_string(f"%.{places}f", round_exact(name, places))
    if places > 0:
        text = F.regexp_replace(text, r"\.?0+$", "")
    return F.when(x.isNull() | F.isnan(x), F.lit("")).otherwise(text)
