"""The test tables in the shapes that the jobs expect, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.names import AGE, COUNT, GENDER, NAME, PREAMBLE, SHEET_SCHEMA
from ..plans.population import POPULATION_COLUMNS
from .registry import Tables


def _names(df: DataFrame, p: str) -> DataFrame:
    """Names out of customers or suppliers: a balance below 0 makes a two-word name."""
    balance = F.col(f"{p}_acctbal")
    return df.select(
        F.when(balance < 0, F.replace(f"{p}_name", F.lit("#"), F.lit(" "))).otherwise(F.col(f"{p}_name")).alias(NAME),
        F.round(F.abs(balance) * 100).cast("bigint").alias(COUNT),
        (F.col(f"{p}_nationkey") + 25.5).alias(AGE),
    )


def male_names(t: Tables) -> DataFrame:
    return _names(t.customer, "c")


def female_names(t: Tables) -> DataFrame:
    return _names(t.supplier, "s")


def names_base(t: Tables) -> DataFrame:
    return male_names(t).withColumn(GENDER, F.lit("Male")).unionByName(female_names(t).withColumn(GENDER, F.lit("Female")))


def _names_sql(table: str, p: str, gender: str) -> str:
    return f"""SELECT CASE WHEN {p}_acctbal < 0 THEN replace({p}_name, '#', ' ') ELSE {p}_name END AS "Nombre",
        CAST(round(abs({p}_acctbal) * 100) AS BIGINT) AS "Frecuencia",
        {p}_nationkey + CAST(25.5 AS DOUBLE) AS "Edad Media (*)", '{gender}' AS "Gender" FROM {table}"""


NAMES_SQL = f"{_names_sql('customer', 'c', 'Male')} UNION ALL {_names_sql('supplier', 's', 'Female')}"

PROCESSED_SQL = f"""SELECT *, NOT ("Nombre" NOT LIKE '% %') AS "Is_Compound",
    "Frecuencia" / sum("Frecuencia") OVER (PARTITION BY "Gender") * 100 AS "Percentage",
    row_number() OVER (PARTITION BY "Gender" ORDER BY "Frecuencia" DESC, "Nombre") AS "Popularity",
    CAST(length("Nombre") AS INTEGER) AS "Character_Count",
    CAST(len(regexp_extract_all(lower("Nombre"), '[aeiouáéíóúü]+')) AS INTEGER) AS "Syllable_Count"
    FROM ({NAMES_SQL}) WHERE "Nombre" NOT LIKE '% %' AND "Gender" = 'Male'"""


def write_sheets(t: Tables) -> str:
    """Both names tables as text files, each with the lines above the table that a workbook has."""

    def with_preamble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        header = ",".join(part.split("`")[1] for part in SHEET_SCHEMA.split(", "))
        yield pa.RecordBatch.from_pydict({"value": [f"note {i}" for i in range(PREAMBLE)] + [header]})
        yield from batches

    folder = t.scratch("sheets")
    for label, names in (("Hombres", male_names(t)), ("Mujeres", female_names(t))):
        lines = names.select(F.to_csv(F.struct(NAME, COUNT, AGE)).alias("value"))
        lines.mapInArrow(with_preamble, "value string").write.text(f"{folder}/{label}")
    return f"{folder}/*"


def _dotted(value) -> F.Column:
    return F.replace(F.format_number(value, 0), F.lit(","), F.lit("."))


def raw_population(t: Tables) -> DataFrame:
    """Population rows as text: provinces are nations, municipalities are customers and market segments."""
    nation = t.nation.select("n_nationkey", F.concat_ws(" ", "n_nationkey", "n_name").alias("province_raw"))
    people = t.spread("customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    gender = F.when(F.col("c_acctbal") < 0, "Mujeres").when(F.col("c_acctbal") < 5000, "Hombres").otherwise("Total")
    town = F.explode(
        F.array(
            F.concat_ws(" ", "c_custkey", "c_name").alias("a"),
            F.concat_ws(" ", "c_custkey", "c_mktsegment").alias("b"),
        )
    )
    towns = people.select(
        F.lit("X").alias("ambito"),
        "province_raw",
        town.alias("municipality_raw"),
        gender.alias("gender"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "Extranjera").otherwise("Total").alias("nationality"),
        F.when(F.col("c_acctbal") < 9000, "2024").otherwise("2023").alias("period"),
        _dotted(F.col("c_custkey") * 1000 + 7).alias("population"),
        F.col("c_custkey").alias("place"),
    )
    sums = t.supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "province_raw",
        F.when(F.col("s_acctbal") < 2000, "Mujeres").when(F.col("s_acctbal") < 4000, "Hombres").otherwise("Total").alias("gender"),
        "s_suppkey",
    )
    provinces = sums.groupBy("province_raw", "gender").agg(F.sum(F.col("s_suppkey") * 100 + 1).alias("n")).select(
        F.lit("X").alias("ambito"),
        "province_raw",
        F.lit("").alias("municipality_raw"),
        "gender",
        F.lit("Total").alias("nationality"),
        F.lit("2024").alias("period"),
        _dotted(F.col("n")).alias("population"),
        F.lit(0).cast("bigint").alias("place"),
    )
    return towns.unionByName(provinces).select(*POPULATION_COLUMNS, "place")


# The loaded population: one nationality, one period, first word of each name.
POPULATION_SQL = """SELECT n_nationkey AS province_id, n_name AS province_name, c_custkey AS municipality_id,
        unnest([c_name, c_mktsegment]) AS municipality_name,
        CASE WHEN c_acctbal < 0 THEN 'Mujeres' WHEN c_acctbal < 5000 THEN 'Hombres' ELSE 'Total' END AS gender,
        c_custkey * 1000 + 7 AS population, c_custkey AS place
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'FURNITURE' AND c_acctbal < 9000
    UNION ALL
    SELECT n_nationkey, n_name, NULL, NULL,
        CASE WHEN s_acctbal < 2000 THEN 'Mujeres' WHEN s_acctbal < 4000 THEN 'Hombres' ELSE 'Total' END AS gender,
        CAST(sum(s_suppkey * 100 + 1) AS BIGINT), 0
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 5"""

# Fixed value of this shape: how a rate is written and which unit a payload names.
UNITS_SQL = "CASE c_mktsegment WHEN 'BUILDING' THEN '%' WHEN 'MACHINERY' THEN '‰' WHEN 'HOUSEHOLD' THEN NULL ELSE '‰' END"


def _unit_json():
    """Present, present as null, or absent."""
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "BUILDING", ',"unidad":"%"')
        .when(segment == "MACHINERY", ',"unidad":"‰"')
        .when(segment == "HOUSEHOLD", ',"unidad":null')
        .otherwise("")
    )


def _rate():
    return F.replace((F.col("c_custkey") / 8).cast("string"), F.lit("."), F.lit(","))


def _payload(first_id, second_id):
    """Two regions that count and three that do not."""
    return F.concat(
        F.lit('{"regiones":[{"id":'), first_id.cast("string"), F.lit(',"val":"'), _rate(), F.lit('"},{"id":"'),
        second_id.cast("string"), F.lit('","val":2.5},{"id":"x","val":1},{"id":3,"val":"1.2,3"},{"val":4}]'),
        _unit_json(), F.lit("}"),
    )


def _of_customers(t: Tables, payload) -> DataFrame:
    gender = F.when(F.col("c_acctbal") < 0, "Female").otherwise("Male")
    return t.spread("customer").select(F.col("c_name").alias("nombre"), gender.alias("gender"), payload.alias("payload"))


def province_payloads(t: Tables) -> DataFrame:
    return _of_customers(t, _payload(F.col("c_nationkey"), F.col("c_nationkey") + 1))


def province_map(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").cast("bigint").alias("region_id"), F.col("n_name").alias("region_name"))


def town_payloads(t: Tables) -> DataFrame:
    return _of_customers(t, _payload(F.col("c_custkey"), -F.ascii("c_mktsegment")))


def town_map(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("region_id"), F.col("c_name").alias("region_name")).unionByName(
        t.customer.select((-F.ascii("c_mktsegment")).cast("bigint").alias("region_id"), F.col("c_mktsegment").alias("region_name")).distinct()
    )


def _rates_sql(first_id: str, second_id: str) -> str:
    return f"""SELECT c_name AS nombre, CASE WHEN c_acctbal < 0 THEN 'Female' ELSE 'Male' END AS gender,
        unnest([CAST({first_id} AS BIGINT), CAST({second_id} AS BIGINT)]) AS region_id,
        unnest([CAST(c_custkey / 8 AS DOUBLE), 2.5]) AS percentage, {UNITS_SQL} AS unidad FROM customer"""


_PERSONS_SQL = """CASE WHEN people IS NULL THEN NULL WHEN unidad = '‰' THEN CAST(round_even(people * (percentage / 1000.0::DOUBLE), 0) AS BIGINT)
        WHEN unidad = '%' THEN CAST(round_even(people * (percentage / 100.0::DOUBLE), 0) AS BIGINT)
        ELSE CAST(round_even(percentage, 0) AS BIGINT) END AS persons"""

_WIDE_SQL = """arg_max(population, place) FILTER (gender = 'Hombres') AS men,
        arg_max(population, place) FILTER (gender = 'Mujeres') AS women,
        arg_max(population, place) FILTER (gender = 'Total') AS everyone"""

TOWN_LOOKUP_SQL = f"""SELECT province_name, municipality_name, {_WIDE_SQL} FROM ({POPULATION_SQL})
    WHERE municipality_name IS NOT NULL GROUP BY 1, 2"""

PROVINCE_ESTIMATES_SQL = f"""WITH rates AS ({_rates_sql('c_nationkey', 'c_nationkey + 1')}),
    wide AS (SELECT province_name, {_WIDE_SQL} FROM ({POPULATION_SQL}) WHERE municipality_name IS NULL GROUP BY 1),
    named AS (SELECT r.*, coalesce(n_name, 'Desconocido') AS region_name FROM rates r LEFT JOIN nation ON region_id = n_nationkey),
    found AS (SELECT n.*, coalesce(CASE gender WHEN 'Male' THEN men ELSE women END, everyone) AS people
        FROM named n LEFT JOIN wide ON region_name = province_name)
    SELECT upper(nombre) || '-' || lower(gender[1]) AS nombre_id, nombre, gender, region_id, region_name, percentage, unidad,
        {_PERSONS_SQL}, 'provincia' AS region_type, region_name AS parent_region_name FROM found"""

TOWN_ESTIMATES_SQL = f"""WITH rates AS ({_rates_sql('c_custkey', '-ascii(c_mktsegment)')}),
    places AS (SELECT c_custkey AS id, c_name AS region_name FROM customer
        UNION SELECT -ascii(c_mktsegment), c_mktsegment FROM customer),
    towns AS ({TOWN_LOOKUP_SQL}),
    shown AS (SELECT DISTINCT province_name AS shown_name FROM ({POPULATION_SQL}) WHERE municipality_name IS NULL AND gender = 'Total'),
    owners AS (SELECT municipality_name, count(*) AS n, min(province_name) AS province_name,
        string_agg(coalesce(shown_name, replace(province_name, '_', ' ')), ', ' ORDER BY coalesce(shown_name, replace(province_name, '_', ' '))) AS parent_region_name
        FROM towns LEFT JOIN shown ON province_name = shown_name GROUP BY 1),
    found AS (SELECT r.*, coalesce(p.region_name, 'Desconocido') AS region_name, parent_region_name,
        coalesce(CASE gender WHEN 'Male' THEN men ELSE women END, everyone) AS people
        FROM rates r LEFT JOIN places p ON region_id = id
        LEFT JOIN owners o ON p.region_name = o.municipality_name
        LEFT JOIN towns w ON o.n = 1 AND w.municipality_name = o.municipality_name AND w.province_name = o.province_name)
    SELECT upper(nombre) || '-' || lower(gender[1]) AS nombre_id, nombre, gender, region_id, region_name, percentage, unidad,
        {_PERSONS_SQL}, 'municipio' AS region_type, parent_region_name FROM found"""


def series_payloads(t: Tables) -> DataFrame:
    """Each order line as a series of four values under three labels; a returned line has no discount."""
    values = F.array(
        F.array("l_quantity", F.when(F.col("l_returnflag") != "R", F.col("l_discount")), "l_extendedprice", "l_tax")
    )
    ticks = F.array(F.lit("quantity"), F.lit("discount"), F.lit("price"))
    return t.spread("lineitem").select(
        F.concat(F.lit(" order "), "l_orderkey").alias("nombre"),
        F.when(F.col("l_linestatus") == "O", "Male").otherwise("Female").alias("gender"),
        F.to_json(F.struct(values.alias("values"), ticks.alias("ticks")), {"ignoreNullFields": "false"}).alias("payload"),
    )


SERIES_SQL = """SELECT * FROM (SELECT ' order ' || l_orderkey AS nombre,
        CASE l_linestatus WHEN 'O' THEN 'Male' ELSE 'Female' END AS gender,
        unnest(['quantity', 'discount', 'price']) AS decade,
        unnest([l_quantity, CASE WHEN l_returnflag <> 'R' THEN l_discount END, l_extendedprice]) AS amount
    FROM lineitem) WHERE amount IS NOT NULL"""

DECADES_SQL = f"""SELECT 'ORDER_' || nombre[8:] || '-' || lower(gender[1]) AS nombre_id, nombre, gender, decade,
    CAST(round_even(amount, 0) AS BIGINT) AS persons FROM ({SERIES_SQL})"""
