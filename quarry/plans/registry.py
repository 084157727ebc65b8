"""All named queries and their oracle SQL, gathered from the query modules."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import assignment_queries, io_queries, migration_queries, text_queries, time_queries
from quarry.session import scratch_scope

_MODULES = [text_queries, time_queries, migration_queries, assignment_queries, io_queries]



def _scoped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, leaving only those scratch tables that its result reads."""
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scratch_scope(spark) as scope:
            return scope.keep(query(spark, sf_dir))

    return run


QUERIES = {}
for _m in _MODULES:
    QUERIES.update({name: _scoped(query) for name, query in _m.QUERIES.items()})


def oracle() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out.update(m.oracle())
    return out
