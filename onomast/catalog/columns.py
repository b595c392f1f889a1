"""Projections, filters and unions: plain Spark, shown once each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import gender_alias, gender_code
from ..functions.numbers import decimal_comma, rate_to_count, round_count, strip_digits_sep
from ..functions.text import is_compound, label_code, label_text
from ..operators.series import explode_regions, explode_series
from ..plans.names import AGE, COUNT, GENDER, NAME, simple_male
from ..plans.population import load_population
from ..sources.readers import parse_regions, parse_series
from .registry import Tables, query
from .shapes import NAMES_SQL, POPULATION_SQL, SERIES_SQL, names_base, province_payloads, raw_population, series_payloads


@query("tag_source", "SELECT c_custkey, c_name, 'customer' AS source FROM customer")
def tag_source(t: Tables):
    return t.customer.select("c_custkey", "c_name").withColumn("source", F.lit("customer"))


@query("select_columns", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def select_columns(t: Tables):
    return t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")


@query("drop_column", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def drop_column(t: Tables):
    return t.customer.drop("c_acctbal", "no_such_column")


@query("rename_positional", "SELECT s_suppkey AS id, s_name AS label, s_nationkey AS place, s_acctbal AS amount FROM supplier")
def rename_positional(t: Tables):
    return t.supplier.toDF("id", "label", "place", "amount")


@query(
    "cast_column",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_orderkey AS DOUBLE) AS key_number,
    CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS price FROM orders""",
)
def cast_column(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderkey").cast("double").alias("key_number"),
        F.col("o_totalprice").cast("string").cast("double").alias("price"),
    )


@query("upper_key", "SELECT p_partkey, upper(p_name) AS p_name FROM part")
def upper_key(t: Tables):
    return t.part.select("p_partkey", F.upper("p_name").alias("p_name"))


@query(
    "row_projection",
    "SELECT l_orderkey AS id, l_linenumber AS line, l_quantity AS amount, CAST(l_quantity AS BIGINT) AS whole FROM lineitem",
)
def row_projection(t: Tables):
    record = F.struct(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("amount"),
        F.col("l_quantity").cast("bigint").alias("whole"),
    )
    return t.lineitem.select(record.alias("record")).select("record.*")


@query(
    "conditional_column",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN o_totalprice END AS big FROM orders",
)
def conditional_column(t: Tables):
    big = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return t.orders.select("o_orderkey", F.when(big, F.col("o_totalprice")).alias("big"))


@query("filter_simple_male", f"""SELECT "Nombre", "Frecuencia" FROM ({NAMES_SQL}) WHERE "Nombre" NOT LIKE '% %' AND lower("Gender") = 'male'""")
def filter_simple_male(t: Tables):
    return names_base(t).withColumn("Is_Compound", is_compound(F.col(NAME))).where(simple_male()).select(NAME, COUNT)


@query("filter_lt", f"""SELECT "Nombre", "Edad Media (*)" FROM ({NAMES_SQL}) WHERE "Edad Media (*)" < 40""")
def filter_lt(t: Tables):
    return names_base(t).where(F.col(AGE) < 40).select(NAME, AGE)


@query("filter_eq", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'")
def filter_eq(t: Tables):
    return t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).select("l_orderkey", "l_linenumber")


@query("filter_key_ci", "SELECT p_partkey, p_name FROM part WHERE upper(p_name) = 'RED WIDGET' AND lower(p_type) = 'economy'")
def filter_key_ci(t: Tables):
    wanted = (F.upper("p_name") == F.upper(F.lit("Red Widget"))) & (F.lower("p_type") == F.lower(F.lit("Economy")))
    return t.part.where(wanted).select("p_partkey", "p_name")


@query("skip_null_points", f"SELECT nombre, gender, decade, amount FROM ({SERIES_SQL})")
def skip_null_points(t: Tables):
    return explode_series(parse_series(series_payloads(t))).withColumn("amount", F.col("amount").cast("double"))


@query("series_explode", f"SELECT decade, count(*) AS points, min(amount) AS low, max(amount) AS high FROM ({SERIES_SQL}) GROUP BY 1")
def series_explode(t: Tables):
    points = explode_series(parse_series(series_payloads(t))).withColumn("amount", F.col("amount").cast("double"))
    return points.groupBy("decade").agg(F.count("*").alias("points"), F.min("amount").alias("low"), F.max("amount").alias("high"))


_REGIONS_SQL = """SELECT c_name AS nombre, unnest([CAST(c_nationkey AS BIGINT), CAST(c_nationkey + 1 AS BIGINT)]) AS region_id,
    unnest([CAST(c_custkey / 8 AS DOUBLE), 2.5]) AS percentage FROM customer"""


@query("skip_bad_regions", _REGIONS_SQL)
def skip_bad_regions(t: Tables):
    return explode_regions(parse_regions(province_payloads(t))).select("nombre", "region_id", "percentage")


@query("regions_explode", f"SELECT region_id, count(*) AS regions, max(percentage) AS highest FROM ({_REGIONS_SQL}) GROUP BY 1")
def regions_explode(t: Tables):
    regions = explode_regions(parse_regions(province_payloads(t)))
    return regions.groupBy("region_id").agg(F.count("*").alias("regions"), F.max("percentage").alias("highest"))


@query("skip_null_population", "SELECT c_custkey, c_custkey * 1000 + 7 AS population FROM customer WHERE c_acctbal >= 0")
def skip_null_population(t: Tables):
    text = F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(F.format_number(F.col("c_custkey") * 1000 + 7, 0))
    rows = t.customer.select("c_custkey", strip_digits_sep(F.replace(text, F.lit(","), F.lit("."))).alias("population"))
    return rows.where("population is not null")


@query(
    "membership",
    """SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand IN ('Brand#3', 'Brand#7', 'Brand#11')
    AND p_type IN (SELECT p_type FROM part GROUP BY 1 HAVING count(*) > 5)""",
)
def membership(t: Tables):
    wanted = F.array(*[F.lit(b) for b in ("Brand#3", "Brand#7", "Brand#11")])
    common = t.part.groupBy("p_type").count().where("count > 5").select("p_type")
    parts = t.part.where(F.array_contains(wanted, F.col("p_brand")))
    return parts.join(common, "p_type", "left_semi").select("p_partkey", "p_name", "p_brand")


_PEOPLE_SQL = """SELECT c_name AS name, c_acctbal AS amount, 'customer' AS source, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, 'supplier', NULL FROM supplier"""


@query("union_by_name", _PEOPLE_SQL)
def union_by_name(t: Tables):
    customers = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"), F.lit("customer").alias("source"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(F.lit("supplier").alias("source"), F.col("s_acctbal").alias("amount"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("union_strict", f"SELECT name, amount FROM ({_PEOPLE_SQL})")
def union_strict(t: Tables):
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"))
    return customers.unionByName(t.supplier.select(F.col("s_acctbal").alias("amount"), F.col("s_name").alias("name")))


@query("strip_digits_sep", "SELECT o_orderkey, o_orderkey * 1000 + 7 AS n FROM orders")
def strip_digits_sep_query(t: Tables):
    text = F.translate(F.format_number(F.col("o_orderkey") * 1000 + 7, 0), ",", ".")
    return t.orders.select("o_orderkey", strip_digits_sep(text).alias("n"))


@query(
    "decimal_comma",
    "SELECT event_id, value AS plain, CASE event_type WHEN 'click' THEN NULL ELSE value END AS checked FROM events",
)
def decimal_comma_query(t: Tables):
    text = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    broken = F.when(F.col("event_type") == "click", F.concat(text, F.lit(",5"))).otherwise(F.concat(F.lit(" "), text))
    return t.events.select("event_id", decimal_comma(text).alias("plain"), decimal_comma(broken).alias("checked"))


@query("round_count", "SELECT o_orderkey, CAST(round_even(o_totalprice * 0.0095::DOUBLE, 0) AS BIGINT) AS n FROM orders")
def round_count_query(t: Tables):
    return t.orders.select("o_orderkey", round_count(F.col("o_totalprice") * 0.0095).alias("n"))


@query(
    "rate_to_count",
    """SELECT o_orderkey, CASE o_orderstatus
        WHEN 'F' THEN CAST(round_even(o_custkey * (o_totalprice / 1000.0::DOUBLE), 0) AS BIGINT)
        WHEN 'O' THEN CAST(round_even(o_custkey * (o_totalprice / 100.0::DOUBLE), 0) AS BIGINT)
        ELSE CAST(round_even(o_totalprice, 0) AS BIGINT) END AS persons FROM orders""",
)
def rate_to_count_query(t: Tables):
    status = F.col("o_orderstatus")
    unit = F.when(status == "F", "‰").when(status == "O", "%")
    return t.orders.select("o_orderkey", rate_to_count(F.col("o_custkey"), F.col("o_totalprice"), unit).alias("persons"))


@query(
    "gender_alias",
    """SELECT nombre, CASE WHEN gender = 'Male' THEN 'Hombres,Total' WHEN gender = 'Female' THEN 'Mujeres,Total' ELSE 'Total' END AS keys
    FROM (SELECT "Nombre" AS nombre, CASE WHEN "Frecuencia" > 500000 THEN 'Other' ELSE "Gender" END AS gender FROM (""" + NAMES_SQL + "))",
)
def gender_alias_query(t: Tables):
    gender = F.when(F.col(COUNT) > 500000, "Other").otherwise(F.col(GENDER))
    return names_base(t).select(F.col(NAME).alias("nombre"), F.array_join(gender_alias(gender), ",").alias("keys"))


@query("gender_code", f"""SELECT "Nombre" AS nombre, CASE "Gender" WHEN 'Male' THEN '1' ELSE '6' END AS code FROM ({NAMES_SQL})""")
def gender_code_query(t: Tables):
    return names_base(t).select(F.col(NAME).alias("nombre"), gender_code(F.col(GENDER)).alias("code"))


@query(
    "split_code_label",
    "SELECT c_custkey AS code, c_name AS first_word, c_name || ' ' || c_mktsegment AS whole FROM customer",
)
def split_code_label(t: Tables):
    label = F.concat_ws(" ", "c_custkey", "c_name", "c_mktsegment")
    return t.customer.select(
        label_code(label).alias("code"), label_text(label).alias("first_word"), label_text(label, "full").alias("whole")
    )


@query(
    "coalesce_label",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name ELSE c_mktsegment END AS label FROM customer",
)
def coalesce_label(t: Tables):
    label = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", F.coalesce(label, "c_name").alias("label"))


@query("load_population", f"SELECT province_id, province_name, municipality_id, municipality_name, gender, population FROM ({POPULATION_SQL})")
def load_population_query(t: Tables):
    return load_population(raw_population(t)).select(
        F.col("province_id").cast("int").alias("province_id"), "province_name", "municipality_id", "municipality_name", "gender", "population"
    )

