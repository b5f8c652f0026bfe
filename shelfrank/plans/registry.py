"""Named queries with, where SQL can express them, an independent SQL text each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


# The canonical tables in SQL, as written in ``shelfrank.views``.
_TABLES = """
users AS (SELECT c_custkey AS user_idx, c_mktsegment AS segment, c_acctbal AS user_attr_0,
  c_nationkey AS nation FROM customer),
items AS (SELECT p_partkey AS item_idx, p_type AS category, p_retailprice AS price,
  p_size AS item_attr_0, p_brand AS brand FROM part),
log0 AS (SELECT o_custkey AS user_idx, l_partkey AS item_idx,
  CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS response,
  CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS relevance,
  o_orderdate AS ts, l_orderkey AS order_id, l_linenumber AS line_no, l_extendedprice AS paid,
  year(o_orderdate) - 1995 AS iter_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
log AS (SELECT log0.*, CASE WHEN iter_no = 0 THEN 'start'
    WHEN iter_no <= 3 THEN 'train_' || (iter_no - 1)::VARCHAR
    ELSE 'test_' || (iter_no - 4)::VARCHAR END AS iter,
  price, response * price AS revenue
  FROM log0 JOIN items USING (item_idx))
"""


def sql(body: str, *steps: str) -> str:
    """SQL text on the canonical tables; ``steps`` are further named sub-queries."""
    return "WITH " + ",\n".join([_TABLES.strip(), *steps]) + "\n" + body
