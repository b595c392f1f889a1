"""Ranks, sorts, top lists and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ranking import limit_head, ordering, rank_in_group, sort_rows, top_k, top_n_per_group
from ..operators.sampling import sample_rows, shuffle_rows
from ..plans.details import region_rates, sort_records
from .registry import Tables, query
from .shapes import province_map, province_payloads

_RANK_SQL = """SELECT o_orderkey, o_orderstatus, o_totalprice,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders"""


def _orders(t: Tables):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("rank_in_group", _RANK_SQL)
def rank_in_group_query(t: Tables):
    return rank_in_group(_orders(t), "o_orderstatus", "o_totalprice", ["o_orderkey"], "rank")


@query("rank_in_group_ranges", _RANK_SQL)
def rank_in_group_ranges(t: Tables):
    return rank_in_group(_orders(t), "o_orderstatus", "o_totalprice", ["o_orderkey"], "rank", plan="range")


@query("top_n_per_group", f"SELECT * FROM ({_RANK_SQL}) WHERE rank <= 5")
def top_n_per_group_query(t: Tables):
    return top_n_per_group(_orders(t), "o_orderstatus", "o_totalprice", 5, ["o_orderkey"])


@query(
    "top_n_per_group_many",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank FROM lineitem) WHERE rank <= 50000""",
)
def top_n_per_group_many(t: Tables):
    """A list too long for one task's top rows: the table is filtered by bounds of the n-th values, not sorted."""
    lines = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")
    top = top_n_per_group(lines, "l_returnflag", "l_extendedprice", 50_000, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return top.drop("l_partkey", "l_suppkey")


@query("sort_multi", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def sort_multi(t: Tables):
    order = [F.asc_nulls_last("c_mktsegment"), *ordering("c_acctbal", ["c_custkey"])]
    customers = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    keys = ["c_mktsegment", "c_acctbal", "c_custkey"]
    return sort_rows(customers, order, keys)


@query(
    "sort_records",
    """SELECT c_name AS nombre, 'provincia' AS region_type, unnest([CAST(c_nationkey AS BIGINT), CAST(c_nationkey + 1 AS BIGINT)]) AS region_id
    FROM customer ORDER BY region_id, nombre""",
)
def sort_records_query(t: Tables):
    rates = region_rates(province_payloads(t), province_map(t), "prov")
    return sort_records(rates).select("nombre", "region_type", "region_id")


@query("limit_head", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 100")
def limit_head_query(t: Tables):
    return limit_head(t.customer.select("c_custkey", "c_name"), 100, [F.asc("c_custkey")], ["c_custkey"])


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 400000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_k_query(t: Tables):
    return top_k(t.orders.where("o_totalprice < 400000").select("o_orderkey", "o_totalprice"), "o_totalprice", 50, ["o_orderkey"])


@query("sample_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 100")
def sample_n(t: Tables):
    return sample_rows(t.orders.select("o_orderkey", "o_totalprice"), "random", 100, "o_orderkey", seed=42)


@query(
    "sample_n_large",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    ORDER BY md5(concat_ws(chr(31), '42:' || l_orderkey, l_linenumber, l_partkey, l_suppkey)), l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20000""",
)
def sample_n_large(t: Tables):
    """A sample too large for one list: only draws below a bound are moved."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return sample_rows(t.lineitem.select(*keys), "random", 20_000, keys, seed=42)


@query("shuffle_all", "SELECT o_orderkey, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) AS position FROM orders")
def shuffle_all(t: Tables):
    return shuffle_rows(t.orders.select("o_orderkey"), "o_orderkey", 7)


@query("sample_mode", "SELECT 'sequential' AS mode, * FROM (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 30) "
    "UNION ALL SELECT 'random', * FROM (SELECT c_custkey FROM customer ORDER BY md5('3:' || c_custkey), c_custkey LIMIT 30) "
    "UNION ALL SELECT 'all', c_custkey FROM customer")  # fmt: skip
def sample_mode(t: Tables):
    keys = t.customer.select("c_custkey")
    chosen = [sample_rows(keys, mode, 30, "c_custkey", seed=3).select(F.lit(mode).alias("mode"), "c_custkey") for mode in ("sequential", "random", "all")]
    return chosen[0].unionByName(chosen[1]).unionByName(chosen[2])
