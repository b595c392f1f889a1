"""Joins: requests, defaults, fallback keys, unique parents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import gender_alias
from ..functions.text import char_count, normalize_label
from ..operators.groups import join_group_total, keep_first
from ..operators.joins import lookup_join
from ..operators.lookups import lookup_default, lookup_fallback, unique_parent
from ..operators.matching import match_requests, missing_requests, select_names
from ..plans.details import estimate_regions
from ..plans.population import VARIANTS, load_population, place_lookup
from .registry import Tables, query
from .shapes import TOWN_ESTIMATES_SQL, raw_population, town_map, town_payloads


def _cents(column: str, out: str):
    return F.round(F.col(column) * 100).cast("bigint").alias(out)


@query(
    "join_group_total",
    """SELECT o_orderkey, o_orderstatus, cents, CAST(sum(cents) OVER (PARTITION BY o_orderstatus) AS BIGINT) AS "cents_Total"
    FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)""",
)
def join_group_total_query(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderstatus", _cents("o_totalprice", "cents"))
    return join_group_total(orders, "o_orderstatus", "cents").select("o_orderkey", "o_orderstatus", "cents", "cents_Total")


REQUESTS = ["5-low", ("2-High", "f"), "5-LOW", ("1-urgent", "X"), ("9-NONE", None)]
_REQUESTS_SQL = "(VALUES (0, '5-LOW', NULL), (1, '2-HIGH', 'f'), (2, '5-LOW', NULL), (3, '1-URGENT', 'x'), (4, '9-NONE', NULL)) r(request, wanted, wanted_group)"


@query(
    "join_requested",
    f"""SELECT CAST(request AS INTEGER) AS request, o_orderkey, o_orderpriority, o_orderstatus FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY request, o_orderkey) AS n
    FROM orders JOIN {_REQUESTS_SQL} ON upper(o_orderpriority) = wanted
        AND (wanted_group IS NULL OR lower(o_orderstatus) = wanted_group)) WHERE n = 1""",
)
def join_requested(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return match_requests(orders, REQUESTS, "o_orderpriority", "o_orderstatus", ["o_orderkey"])


_WANTED_SQL = "SELECT c_custkey AS request, upper(c_name) AS wanted, CASE WHEN c_nationkey % 2 = 1 THEN 'f' END AS wanted_group FROM customer WHERE c_custkey % 5 = 0"


@query(
    "join_requested_many",
    f"""SELECT request, name, o_orderstatus, o_orderkey FROM (
    SELECT *, row_number() OVER (PARTITION BY name, o_orderstatus ORDER BY request, o_orderkey) AS n
    FROM (SELECT upper('customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS name, o_orderstatus, o_orderkey FROM orders)
    JOIN ({_WANTED_SQL}) ON name = wanted AND (wanted_group IS NULL OR lower(o_orderstatus) = wanted_group)) WHERE n = 1""",
)
def join_requested_many(t: Tables):
    """Requests as a table, met by a filter of their names."""
    orders = t.orders.select(F.concat(F.lit("customer#"), F.lpad("o_custkey", 9, "0")).alias("name"), "o_orderstatus", "o_orderkey")
    group = F.when(F.col("c_nationkey") % 2 == 1, "f").alias("wanted_group")
    wanted = t.customer.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("request"), F.upper("c_name").alias("wanted_name"), group)
    return match_requests(orders, wanted, "name", "o_orderstatus", ["o_orderkey"], listed=10)


@query(
    "join_requested_missing",
    f"""SELECT CAST(request AS INTEGER) AS request, wanted AS wanted_name, wanted_group FROM {_REQUESTS_SQL}
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE upper(o_orderpriority) = wanted
        AND (wanted_group IS NULL OR lower(o_orderstatus) = wanted_group))""",
)
def join_requested_missing(t: Tables):
    return missing_requests(t.orders, REQUESTS, "o_orderpriority", "o_orderstatus")


@query(
    "select_names",
    """SELECT upper(c_name) AS c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
    ORDER BY c_mktsegment, c_acctbal DESC, c_custkey LIMIT 20""",
)
def select_names_query(t: Tables):
    return select_names(t.customer, "c_name", "c_mktsegment", "c_acctbal", ["c_custkey"], only_group="building", top=20)


@query(
    "select_names_listed",
    """SELECT upper(p_name) AS p_name, p_type, CAST(CASE upper(p_name) WHEN 'RED WIDGET' THEN 0 ELSE 1 END AS INTEGER) AS request
    FROM part WHERE upper(p_name) IN ('RED WIDGET', 'BLUE BOLT') AND p_type = 'ECONOMY'""",
)
def select_names_listed(t: Tables):
    return select_names(
        t.part, "p_name", "p_type", "p_size", ["p_partkey"], names=["Red Widget", "blue bolt"], only_group="Economy"
    )


@query(
    "lookup_default",
    """SELECT c_custkey, coalesce(n_name, 'Desconocido') AS n_name FROM customer LEFT JOIN
    (nation JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA') ON c_nationkey = n_nationkey""",
)
def lookup_default_query(t: Tables):
    regions = t.region.where("r_name <> 'ASIA'")
    known = t.nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).withColumnRenamed("n_nationkey", "c_nationkey")
    return lookup_default(t.customer, known, "c_nationkey", "n_name", "Desconocido").select("c_custkey", "n_name")


@query(
    "lookup_fallback_key",
    """WITH lookup AS (SELECT s_nationkey,
        CAST(sum(CASE WHEN s_acctbal >= 7000 THEN s_suppkey END) AS BIGINT) AS men,
        CAST(sum(CASE WHEN s_acctbal < 2000 THEN s_suppkey END) AS BIGINT) AS women,
        CAST(sum(s_suppkey) AS BIGINT) AS everyone FROM supplier GROUP BY 1)
    SELECT c_custkey, coalesce(CASE c_mktsegment WHEN 'MACHINERY' THEN men WHEN 'FURNITURE' THEN women END, everyone) AS people
    FROM customer LEFT JOIN lookup ON c_nationkey = s_nationkey""",
)
def lookup_fallback_key(t: Tables):
    place = F.col("s_nationkey").alias("c_nationkey")
    people = F.sum("s_suppkey").alias("people")
    rows = [("Hombres", F.col("s_acctbal") >= 7000), ("Mujeres", F.col("s_acctbal") < 2000), ("Total", F.lit(True))]
    tables = [t.supplier.where(c).groupBy(place).agg(people).withColumn("gender", F.lit(g)) for g, c in rows]
    lookup = tables[0].unionByName(tables[1]).unionByName(tables[2])
    wanted = gender_alias(F.left("c_mktsegment", F.lit(1)))
    found = lookup_fallback(t.customer, lookup, ["c_nationkey"], "gender", "people", wanted, VARIANTS, "gender")
    return found.select("c_custkey", "people")


@query(
    "lookup_unique_parent",
    """SELECT o_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS l_returnflag,
    string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS candidates
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
)
def lookup_unique_parent(t: Tables):
    pairs = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    return unique_parent(t.orders.select("o_orderkey"), pairs, "o_orderkey", "l_returnflag")


@query(
    "display_name",
    """WITH shown AS (SELECT upper(p_name) AS k, arg_min(p_name, p_partkey) AS label FROM part WHERE p_size > 48 GROUP BY 1)
    SELECT p_partkey, coalesce(label, upper(p_name)) AS label FROM part LEFT JOIN shown ON upper(p_name) = k""",
)
def display_name(t: Tables):
    keyed = t.part.withColumn("k", normalize_label(F.col("p_name")))
    shown = keep_first(keyed.where("p_size > 48"), ["k"], "p_partkey", "p_name", "label")
    return lookup_join(keyed, shown, "k").select("p_partkey", F.coalesce("label", "k").alias("label"))


@query("zip_rows", "SELECT p_partkey, p_name, CAST(length(p_name) AS INTEGER) AS letters FROM part")
def zip_rows(t: Tables):
    answers = t.part.select("p_name").distinct().select("p_name", char_count(F.col("p_name")).alias("letters"))
    return lookup_join(t.part.select("p_partkey", "p_name"), answers, "p_name").select("p_partkey", "p_name", "letters")


@query("lookup_estimate", TOWN_ESTIMATES_SQL)
def lookup_estimate(t: Tables):
    places = place_lookup(load_population(raw_population(t)), "place")
    return estimate_regions(town_payloads(t), town_map(t), places, "muni")
