"""Compare a registered query with its SQL twin, value by value."""

from __future__ import annotations

import math

import duckdb

from sitegrade.bindings.common import TABLES

_WHOLE = ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT")
_SPARK = {"int": "whole", "bigint": "whole", "smallint": "whole", "double": "real",
          "float": "real", "string": "text", "boolean": "flag"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(duck_type: str) -> str:
    if duck_type in _WHOLE:
        return "whole"
    return {"DOUBLE": "real", "FLOAT": "real", "VARCHAR": "text", "BOOLEAN": "flag"}.get(
        duck_type, duck_type
    )


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return repr(value)


def compare(df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """Differences between a Spark result and its twin, empty when they agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    problems = []
    if set(df.columns) != set(expected_types):
        return [f"columns {sorted(df.columns)} vs {sorted(expected_types)}"]
    for name, spark_type in df.dtypes:
        if _SPARK.get(spark_type, spark_type) != _kind(expected_types[name]):
            problems.append(f"type of {name}: {spark_type} vs {expected_types[name]}")
    names = sorted(df.columns)
    got = sorted(tuple(_cell(r[c]) for c in names) for r in df.collect())
    order = [relation.columns.index(c) for c in names]
    want = sorted(tuple(_cell(r[i]) for i in order) for r in relation.fetchall())
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        problems.append(f"{len(a)} rows only in Spark, {len(b)} only in SQL")
        for label, rows in (("spark", a), ("sql", b)):
            for row in sorted(rows)[:3]:
                problems.append(f"  {label}: " + ", ".join(f"{n}={v}" for n, v in zip(names, row)))
    return problems
