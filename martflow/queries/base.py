"""Registration and shared pieces of the queries."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.layout import Field
from ..sources.tables import read_parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL counterpart."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return report(fn(spark, sf_dir))

        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def report(df: DataFrame) -> DataFrame:
    """Plain result types: dates and times as text, decimals as double."""
    shown = []
    for f in df.schema:
        kind, c = f.dataType.simpleString().split("(")[0], F.col(f"`{f.name}`")
        if kind == "date":
            c = c.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            c = c.cast("double")
        shown.append(c.alias(f.name))
    return df.select(*shown)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, sf_dir, name)


# Rules that read a number, by name; those of texts and dates are named below.
_NUMBERS = "keep zero one is_zero none_or_zero positive is_one bigint decimal decimal_one".split()


def _filling(column: str, rule: str, key: str) -> str:
    """A value that varies with ``key`` and suits a rule; some are NULL."""
    some = f"{key} % {3 + len(column) % 5}"
    if rule in _NUMBERS:
        return f"CASE WHEN {some} <> 1 THEN {some} END"
    if rule in ("bool", "is_true", "boolean"):
        return f"CASE WHEN {some} <> 1 THEN {some} = 0 END"
    if rule in ("is_J", "is_O", "is_G"):
        return f"CASE {some} WHEN 0 THEN '{rule[-1]}' WHEN 1 THEN 'N' END"
    if rule in ("date", "timestamp"):
        return f"CASE WHEN {some} <> 1 THEN CAST('2021-03-04 05:06:07' AS TIMESTAMP) END"
    return f"CASE WHEN {some} <> 1 THEN concat(' {column} ', CAST({some} AS STRING), ' ') END"


# What each rule gives, as SQL over a source column.
RULES_SQL = {
    "keep": "{c}",
    "text": "trim(coalesce(CAST({c} AS VARCHAR), ''))",
    "string_text": "trim(coalesce(CAST({c} AS VARCHAR), ''))",
    "trim": "trim({c})",
    "lower": "lower(CAST({c} AS VARCHAR))",
    "eur": "trim(coalesce({c}, 'EUR'))",
    "zero": "coalesce({c}, 0)",
    "one": "coalesce({c}, 1)",
    "bool": "coalesce({c}, false)",
    "is_zero": "coalesce({c} = 0, false)",
    "none_or_zero": "coalesce({c}, 0) = 0",
    "positive": "coalesce({c} > 0, false)",
    "is_one": "coalesce({c} = 1, false)",
    "is_true": "coalesce({c}, false)",
    "is_J": "coalesce({c} = 'J', false)",
    "is_O": "coalesce({c} = 'O', false)",
    "is_G": "coalesce({c} = 'G', false)",
    "not_blank": "coalesce({c} <> ' ', false)",
    "date": "CAST(CAST({c} AS DATE) AS VARCHAR)",
    "timestamp": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
    "bigint": "CAST({c} AS BIGINT)",
    "string": "CAST({c} AS VARCHAR)",
    "boolean": "CAST({c} AS BOOLEAN)",
    "decimal": "CAST({c} AS DOUBLE)",
    "decimal_one": "CAST(coalesce({c}, 1) AS DOUBLE)",
}


def layout_sql(fields: tuple[Field, ...], decimals: str = "") -> str:
    """The projection of a layout as SQL; ``decimals`` names decimal sources."""
    shown = []
    for f in fields:
        value = RULES_SQL[f.rule].format(c=f.source)
        if f.source.rpartition(".")[2] in decimals.split():
            value = f"CAST({value} AS DOUBLE)"
        shown.append(f"{value} AS {f.name}")
    return ", ".join(shown)


class Derived:
    """A table derived from the test tables by SQL that both engines read.

    ``{name}`` in the text stands for a table or for another derived one.
    """

    def __init__(self, text: str, **parts: "Derived"):
        self.text, self.parts = text, parts

    def wide(self, *layouts: tuple[tuple[Field, ...], str]) -> "Derived":
        """The table with values in all source columns of some layouts.

        A column that the text doesn't make varies with the first one, a number.
        """
        made = re.findall(r"\bAS ([a-z]\w*)", self.text)
        lacking = {
            f.source.removeprefix(prefix): f.rule
            for fields, prefix in layouts
            for f in reversed(fields)
            if f.source.startswith(prefix) and f.source.removeprefix(prefix) not in made
        }
        if not lacking:
            return self
        filled = ", ".join(f"{_filling(c, r, made[0])} AS {c}" for c, r in lacking.items())
        return Derived(f"SELECT w.*, {filled} FROM ({self.text}) w", **self.parts)

    def _names(self) -> list[str]:
        return [n for n in TABLES if "{" + n + "}" in self.text]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = {n: table(spark, sf_dir, n) for n in self._names()}
        frames |= {n: d.frame(spark, sf_dir) for n, d in self.parts.items()}
        return spark.sql(self.text, **frames)

    @property
    def sql(self) -> str:
        names = {n: n for n in self._names()}
        return self.text.format(**names, **{n: f"({d.sql})" for n, d in self.parts.items()})


TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
)


def sql_marked(*expressions: str) -> str:
    """Values with NULL and separators marked, as the keys and hashes use them."""
    escaped = r"replace(replace(CAST({e} AS VARCHAR), '\', '\\'), '|', '\p')"
    return ", ".join(rf"coalesce({escaped.format(e=e)}, '\N')" for e in expressions)


def sql_uuid(text: str) -> str:
    groups, shape = "(.{8})(.{4})(.{4})(.{4})(.{12})", r"\1-\2-\3-\4-\5"
    return f"regexp_replace(md5({text}), '{groups}', '{shape}')"


def sql_key(*expressions: str) -> str:
    """The SQL of a surrogate key."""
    return sql_uuid(f"concat_ws('||', {sql_marked(*expressions)})")


def sql_hash(*expressions: str) -> str:
    """The SQL of a row hash."""
    return f"md5(concat_ws('|', {sql_marked(*expressions)}))"
