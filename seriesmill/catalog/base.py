"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmill.functions.scalar import rnd, to_ms
from seriesmill.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB equivalent on the given tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def fragment(name: str, deps: Sequence[str], body: str) -> None:
    """A named CTE that other SQL can require."""
    FRAGMENTS[name] = (tuple(deps), body)


def sql(deps: Sequence[str], select: str) -> str:
    """``select`` preceded by the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in FRAGMENTS[name][0]:
            visit(dep)
        ordered.append(name)

    for dep in deps:
        visit(dep)
    ctes = ",\n".join(FRAGMENTS[n][1].strip() for n in ordered)
    return f"WITH RECURSIVE {ctes}\n{select.strip()}" if ordered else select.strip()


# --- SQL text helpers ---------------------------------------------------------------

def r6(x: str, name: str | None = None, digits: int = 6) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), {digits}) + 0.0" + (f" AS {name}" if name else "")


def fl(condition: str, name: str | None = None) -> str:
    out = f"CAST(CAST(COALESCE({condition}, FALSE) AS INTEGER) AS DOUBLE)"
    return out + (f" AS {name}" if name else "")


def roll(agg: str, x: str, n: int, *, shift: int = 0, key: str = "symbol") -> str:
    frame = (f"OVER (PARTITION BY {key} ORDER BY i ROWS BETWEEN {n - 1 + shift} PRECEDING AND "
             + ("CURRENT ROW)" if shift == 0 else f"{shift} PRECEDING)"))
    return f"CASE WHEN count({x}) {frame} >= {n} THEN {agg}({x}) {frame} END"


def uniform_sql(text: str, seed: int = 42) -> str:
    """A uniform number from the first 32 bits of an MD5 of ``text`` and the seed."""
    return f"(('0x' || substr(md5({text} || '|{seed}'), 1, 8))::UBIGINT)::DOUBLE / 4294967296.0::DOUBLE"


def lagged(x: str, k: int = 1, key: str = "symbol") -> str:
    return f"lag({x}, {k}) OVER (PARTITION BY {key} ORDER BY i)"


def running(agg: str, x: str, key: str = "symbol", strict: bool = False) -> str:
    end = "1 PRECEDING" if strict else "CURRENT ROW"
    return f"{agg}({x}) OVER (PARTITION BY {key} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND {end})"


def ffill(x: str, key: str = "symbol", strict: bool = False) -> str:
    end = "1 PRECEDING" if strict else "CURRENT ROW"
    return (f"last_value({x} IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY i "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND {end})")


def out_columns(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ("symbol",),
                digits: int = 6) -> DataFrame:
    """Ids, ``ts`` as epoch ms, and rounded doubles."""
    when = [to_ms(F.col("ts")).alias("ts_ms")] if "ts" in df.columns else []
    return df.select(*ids, *when, *[rnd(c, digits).alias(c) for c in columns])


_SHARED: dict[tuple[str, str, str], DataFrame] = {}


def shared(spark: SparkSession, sf_dir: str, name: str, build: Query) -> DataFrame:
    """A derived table several queries read, written once per session.

    It stands for the stored feature and label tables that dataset, model and drift jobs
    read instead of recomputing them.
    """
    from seriesmill.plans.materialize import settle
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SHARED:
        _SHARED[key] = settle(build(spark, sf_dir))
    return _SHARED[key]


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars that matrix and labels read several times each."""
    from seriesmill.sources.ticks import bars
    return shared(spark, sf_dir, "bars", bars)


def forget_shared() -> None:
    """Drop the session's shared tables (measurements start from the given tables)."""
    _SHARED.clear()
