"""Registry of named queries: a DataFrame builder plus (optionally) its DuckDB oracle.

Each builder receives a ``Tables`` handle and returns a DataFrame; builders
that fit models, run streams or stage tables execute Spark jobs.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession

from tickwise.plans.views import with_views
from tickwise.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: Optional[str]
    bench: bool = False


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: Optional[str] = None, views: tuple[str, ...] = (), bench: bool = False):
    """Decorator: register ``fn(tables) -> DataFrame`` under ``name``."""

    def deco(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        full_sql = with_views(sql, *views) if (sql and views) else sql
        full_sql = binary_round_sql(full_sql) if full_sql else full_sql
        REGISTRY[name] = Query(name, fn, full_sql, bench)
        return fn

    return deco


def binary_round_sql(sql: str) -> str:
    """Rewrite every ``round(expr, d)`` of the oracle text as ``round(expr * 10^d) / 10^d``.

    Mirrors ``functions.columns.r4`` so both engines round the same double.
    Only the literal-digit two-argument form is touched.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, -1
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        digits = sql[comma + 1:k].strip() if comma > 0 else ""
        if comma < 0 or not digits.isdigit():
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        inner = binary_round_sql(sql[j + 6:comma])
        scale = f"CAST({10 ** int(digits)} AS DOUBLE)"
        out.append(sql[i:j])
        out.append(f"(round(({inner}) * {scale}) / {scale})")
        i = k + 1


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    _load()
    return REGISTRY[name].build(Tables(spark, sf_dir))


def spark_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {n: (lambda spark, sf_dir, _q=q: _q.build(Tables(spark, sf_dir))) for n, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {n: q.sql for n, q in REGISTRY.items() if q.sql}


def bench_names() -> list[str]:
    _load()
    return [n for n, q in REGISTRY.items() if q.bench]


def _load() -> None:
    # Importing the query modules fills the registry.
    from tickwise.plans import queries, queries_analytics, queries_edges, queries_indexes, queries_models, queries_sources, queries_streams  # noqa: F401,E501
