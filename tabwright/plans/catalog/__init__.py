"""Registered queries, each with the SQL that must give the same rows where SQL can.

A query is (spark, folder of the tables) -> DataFrame and reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabwright.plans.catalog import clean_queries, evaluate_queries, model_queries, profile_queries, sample_queries

Query = Callable[[SparkSession, str], DataFrame]

_PARTS = [profile_queries, clean_queries, sample_queries, evaluate_queries, model_queries]


def all_queries() -> dict[str, Query]:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.SQL.items()}
