"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables; builders that fit a model, checkpoint or run a stream do so at once.  Column names match the oracle SQL exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, operators: str):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, operators)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills REGISTRY.
    from . import q_files, q_inference, q_io, q_scoring, q_streaming, q_tags  # noqa: F401
    return REGISTRY
