"""Registered queries: name, Spark function, and the same question as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is omitted where SQL cannot state the answer."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_row_text(*columns: tuple[str, str]) -> str:
    """SQL for the portable row encoding. Kinds: int, text, double, time."""
    texts = {
        "int": "cast({c} AS VARCHAR)",
        "text": "{c}",
        "double": "cast(cast({c} AS DECIMAL(38,6)) AS VARCHAR)",
        "time": "cast(epoch_us({c}) AS VARCHAR)",
    }
    parts = []
    for expr, kind in columns:
        t = texts[kind].format(c=expr)
        parts.append(f"coalesce(length({t}) || ':' || {t}, 'N')")
    return " || ".join(parts)


def sql_content_hash(row_text: str) -> str:
    """SQL for the portable content hash of a group."""
    term = f"cast('0x' || substr(md5({row_text}), 1, 15) AS BIGINT)"
    return f"coalesce(cast(sum({term}) AS VARCHAR), '0') || ':' || cast(count(*) AS VARCHAR)"
