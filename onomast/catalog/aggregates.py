"""Totals, profiles, maps and candidate sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.enrich import ORIGINS, validate_domain
from ..operators.groups import candidates, group_total, keep_first, keep_last, profile, share_of_group, value_counts
from ..operators.ranking import distinct_by_key
from ..plans.names import young_popular_report
from .matches import _cents
from .registry import Tables, query
from .shapes import NAMES_SQL, names_base


@query("group_sum", "SELECT l_returnflag, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY 1")
def group_sum(t: Tables):
    return group_total(t.lineitem.select("l_returnflag", _cents("l_extendedprice", "cents")), "l_returnflag", "cents")


@query("share_of_group", "SELECT p_partkey, p_brand, round(p_size / sum(p_size) OVER (PARTITION BY p_brand) * 100, 6) AS share FROM part")
def share_of_group_query(t: Tables):
    shared = share_of_group(t.part, "p_brand", "p_size", "share")
    return shared.select("p_partkey", "p_brand", F.round("share", 6).alias("share"))


@query(
    "profile_minmax",
    f"""SELECT count(*) AS rows, min("Edad Media (*)") AS "min_Edad Media (*)", max("Edad Media (*)") AS "max_Edad Media (*)",
    min("Frecuencia") AS "min_Frecuencia", max("Frecuencia") AS "max_Frecuencia",
    count(*) FILTER ("Edad Media (*)" < 40) AS kept_rows,
    min("Edad Media (*)") FILTER ("Edad Media (*)" < 40) AS "kept_min_Edad Media (*)",
    max("Edad Media (*)") FILTER ("Edad Media (*)" < 40) AS "kept_max_Edad Media (*)",
    min("Frecuencia") FILTER ("Edad Media (*)" < 40) AS "kept_min_Frecuencia",
    max("Frecuencia") FILTER ("Edad Media (*)" < 40) AS "kept_max_Frecuencia" FROM ({NAMES_SQL})""",
)
def profile_minmax(t: Tables):
    return young_popular_report(names_base(t))


@query("count_rows", "SELECT count(*) AS rows, count(*) FILTER (o_orderstatus = 'F') AS kept_rows FROM orders")
def count_rows(t: Tables):
    return profile(t.orders, [], keep=F.col("o_orderstatus") == "F")


@query("count_true", "SELECT count(*) AS rows, count(*) FILTER (l_discount > 0.05) AS cheap, count(*) FILTER (l_returnflag = 'R') AS back FROM lineitem")
def count_true(t: Tables):
    return profile(t.lineitem, [], {"cheap": F.col("l_discount") > 0.05, "back": F.col("l_returnflag") == "R"})


@query("value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1")
def value_counts_query(t: Tables):
    return value_counts(t.orders, "o_orderpriority")


@query("last_wins_map", "SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1")
def last_wins_map(t: Tables):
    return keep_last(t.orders, ["o_custkey"], "o_orderkey", "o_totalprice")


@query("first_wins_map", "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1")
def first_wins_map(t: Tables):
    return keep_first(t.orders, ["o_custkey"], "o_orderkey", "o_orderpriority")


_CANDIDATES_SQL = "SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ', ') AS candidates FROM orders GROUP BY 1"


@query("collect_candidates", _CANDIDATES_SQL)
def collect_candidates(t: Tables):
    sets = candidates(t.orders, "o_custkey", "o_orderpriority")
    return sets.select("o_custkey", F.array_join("candidates", ", ").alias("candidates"))


@query("join_text", "SELECT l_suppkey, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1")
def join_text(t: Tables):
    return candidates(t.lineitem, "l_suppkey", "l_returnflag").select("l_suppkey", F.array_join("candidates", ", ").alias("flags"))


@query(
    "distinct_by_key",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) = 1""",
)
def distinct_by_key_query(t: Tables):
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return distinct_by_key(lines, ["l_partkey"], [F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_extendedprice")])


@query(
    "origin_domain",
    """SELECT origin, count(*) AS rows FROM (SELECT CASE p_type WHEN 'PROMO' THEN 'Vasco' WHEN 'SMALL' THEN 'Griego'
    WHEN 'LARGE' THEN 'Marciano' ELSE p_type END AS origin FROM part) WHERE origin NOT IN ('Vasco', 'Griego') GROUP BY 1""",
)
def origin_domain(t: Tables):
    kind = F.col("p_type")
    origin = F.when(kind == "PROMO", "Vasco").when(kind == "SMALL", "Griego").when(kind == "LARGE", "Marciano").otherwise(kind)
    return validate_domain(t.part.select(origin.alias("origin")), "origin", ORIGINS)
