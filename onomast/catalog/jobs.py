"""Whole jobs."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators.enrich import CallProvider, RuleProvider, enrich
from ..plans.details import decade_series, estimate_regions, name_details
from ..plans.enrichment import enrich_names
from ..plans.names import COUNT, GENDER, NAME, build_names_base, process_names, young_popular_names, young_popular_profile
from ..plans.national import us_national, us_state
from ..plans.population import load_population, municipality_lookup, place_lookup
from ..sources.writers import write_headerless
from .registry import Tables, query
from .shapes import (
    DECADES_SQL,
    NAMES_SQL,
    PROCESSED_SQL,
    PROVINCE_ESTIMATES_SQL,
    TOWN_ESTIMATES_SQL,
    TOWN_LOOKUP_SQL,
    names_base,
    province_map,
    province_payloads,
    raw_population,
    series_payloads,
    town_map,
    town_payloads,
    write_sheets,
)

@query("build_names_base", f'SELECT "Gender", count(*) AS names, CAST(sum("Frecuencia") AS BIGINT) AS people FROM ({NAMES_SQL}) GROUP BY 1')
def build_names_base_query(t: Tables):
    base = build_names_base(t.spark, write_sheets(t))
    return base.groupBy(GENDER).agg(F.count(NAME).alias("names"), F.sum(COUNT).alias("people"))


_ROUNDED_SQL = f'SELECT * REPLACE (round("Percentage", 6) AS "Percentage") FROM ({PROCESSED_SQL})'


@query("process_names", _ROUNDED_SQL)
def process_names_query(t: Tables):
    return process_names(names_base(t)).withColumn("Percentage", F.round("Percentage", 6))


@query(
    "young_popular_names",
    f"""{_ROUNDED_SQL} WHERE "Edad Media (*)" < 40
    ORDER BY "Frecuencia" DESC, "Nombre", "Gender" LIMIT 50""",
)
def young_popular_names_query(t: Tables):
    return young_popular_names(process_names(names_base(t))).withColumn("Percentage", F.round("Percentage", 6))


def _profile_sql(scope: str, rows: str) -> str:
    return f"""SELECT '{scope}' AS scope, "Gender", count(*) AS rows, min("Edad Media (*)") AS min_age, max("Edad Media (*)") AS max_age,
    min("Frecuencia") AS min_count, max("Frecuencia") AS max_count, count(*) FILTER ("Is_Compound") AS compound
    FROM ({rows}) GROUP BY ROLLUP ("Gender")"""


_YOUNG_SQL = f'SELECT * FROM ({PROCESSED_SQL}) WHERE "Edad Media (*)" < 40'
_CHOSEN_SQL = f'{_YOUNG_SQL} ORDER BY "Frecuencia" DESC, "Nombre", "Gender" LIMIT 50'


@query(
    "young_popular_profile",
    " UNION ALL ".join([_profile_sql("all", PROCESSED_SQL), _profile_sql("young", _YOUNG_SQL), _profile_sql("chosen", _CHOSEN_SQL)]),
)
def young_popular_profile_query(t: Tables):
    return young_popular_profile(process_names(names_base(t)))


@query("decade_series", DECADES_SQL)
def decade_series_query(t: Tables):
    return decade_series(series_payloads(t))


@query("estimate_regions", PROVINCE_ESTIMATES_SQL)
def estimate_regions_query(t: Tables):
    places = place_lookup(load_population(raw_population(t)), "place")
    return estimate_regions(province_payloads(t), province_map(t), places, "prov")


@query(
    "build_population_lookups",
    f"""SELECT upper(replace(province_name, '_', ' ')) AS province_key, upper(replace(municipality_name, '#', ' ')) AS municipality_key,
    men AS v0, women AS v1, everyone AS v2 FROM ({TOWN_LOOKUP_SQL})""",
)
def build_population_lookups(t: Tables):
    return municipality_lookup(place_lookup(load_population(raw_population(t)), "place"))


TARGETS = ["customer#000000003", ("Customer#000000005", "male"), "CUSTOMER#000000008", "nobody"]
_TARGETS_SQL = """nombre IN ('CUSTOMER#000000003', 'CUSTOMER#000000008') OR (nombre = 'CUSTOMER#000000005' AND gender = 'Male')"""


@query(
    "name_details",
    f"""WITH chosen AS (SELECT upper(c_name) AS nombre, CASE WHEN c_acctbal < 0 THEN 'Female' ELSE 'Male' END AS gender FROM customer),
    targets AS (SELECT * FROM chosen WHERE {_TARGETS_SQL})
    SELECT 'decades' AS detail, nombre, gender, decade AS label, CAST(round_even(c_acctbal, 0) AS BIGINT) AS persons
        FROM (SELECT upper(c_name) AS nombre, CASE WHEN c_acctbal < 0 THEN 'Female' ELSE 'Male' END AS gender, 'now' AS decade, c_acctbal
        FROM customer) SEMI JOIN targets USING (nombre, gender)
    UNION ALL SELECT 'municipios', nombre, gender, region_name, persons
        FROM (SELECT * REPLACE (upper(nombre) AS nombre) FROM ({TOWN_ESTIMATES_SQL})) SEMI JOIN targets USING (nombre, gender)
    UNION ALL SELECT 'provincias', nombre, gender, region_name, persons
        FROM (SELECT * REPLACE (upper(nombre) AS nombre) FROM ({PROVINCE_ESTIMATES_SQL})) SEMI JOIN targets USING (nombre, gender)""",
)
def name_details_query(t: Tables):
    gender = F.when(F.col("c_acctbal") < 0, "Female").otherwise("Male")
    base = t.customer.select(F.col("c_name").alias(NAME), gender.alias(GENDER))
    series = t.customer.select(
        F.upper("c_name").alias("nombre"),
        gender.alias("gender"),
        F.concat(F.lit('{"values":[['), "c_acctbal", F.lit(',null,3]],"ticks":["now","then"]}')).alias("payload"),
    )
    views = {"prov": province_payloads(t), "muni": town_payloads(t)}
    payloads = [p.withColumn("vista", F.lit(v)).withColumn("nombre", F.upper("nombre")) for v, p in views.items()]
    tables = name_details(
        base,
        series,
        payloads[0].unionByName(payloads[1]),
        {"prov": province_map(t), "muni": town_map(t)},
        place_lookup(load_population(raw_population(t)), "place"),
        TARGETS,
    )
    labels = {"decades": "decade", "municipios": "region_name", "provincias": "region_name"}
    parts = [
        tables[k].select(F.lit(k).alias("detail"), "nombre", "gender", F.col(label).alias("label"), "persons")
        for k, label in labels.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


RULES = [("^red|^blue", "Vasco"), ("bolt$", "Alemán")]
_ORIGIN_SQL = """CASE WHEN regexp_matches(name, '^red|^blue') THEN 'Vasco' WHEN regexp_matches(name, 'bolt$') THEN 'Alemán' ELSE 'Desconocido' END"""
_TITLE_SQL = "array_to_string(list_transform(string_split(name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')"
_HARD_SQL = "regexp_matches(name, '[kwy]|tx|ll|rr')"


def _enriched_sql(source: str) -> str:
    return f"""SELECT id, name, {_ORIGIN_SQL} AS "Family_Origin",
        {_TITLE_SQL} || ' es un nombre de origen ' || {_ORIGIN_SQL} || '.' AS "Name_Description",
        CASE WHEN {_HARD_SQL} THEN 'difícil' ELSE 'muy fácil' END AS "Pronunciation_Spanish",
        CASE WHEN {_HARD_SQL} THEN 'muy difícil' ELSE 'fácil' END AS "Pronunciation_Foreign",
        'Suena como se escribe: ' || {_TITLE_SQL} AS "Pronunciation_Explanation" FROM ({source})"""


_PARTS_SQL = "SELECT p_partkey AS id, p_name AS name FROM part"


def _parts(t: Tables):
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def answerer():
    """What a model might reply, the same as the rules. Made here so that it is sent to the executors whole."""

    def answer(task: str, name: str, prompt: str) -> str:
        origin = "Vasco" if name.startswith(("red", "blue")) else "Alemán" if name.endswith("bolt") else "Desconocido"
        if task == "origin":
            return json.dumps({"origin": origin})
        if task == "description":
            return f"**{name}** es un nombre de origen {origin}."
        hard = any(s in name for s in ("k", "w", "y", "tx", "ll", "rr"))
        levels = ("difícil", "muy difícil") if hard else ("muy fácil", "fácil")
        return json.dumps({"spanish": levels[0], "foreign": levels[1], "explanation": f"Suena como se escribe: {name}"})

    return answer


@query("enrich_columns", _enriched_sql(_PARTS_SQL))
def enrich_columns(t: Tables):
    return enrich(_parts(t), "name", RuleProvider(RULES))


@query("enrich_calls", _enriched_sql(_PARTS_SQL))
def enrich_calls(t: Tables):
    return enrich(_parts(t), "name", CallProvider(answerer(), max_concurrent=64))


def unreliable():
    """The same replies, but for questions that fail: an error for names with an m in front, none about the sound of those that end in t."""
    answer = answerer()

    def fail(task: str, name: str, prompt: str) -> str | None:
        if name.startswith("m"):
            raise ValueError(name)
        return None if name.endswith("t") and task == "pronunciation" else answer(task, name, prompt)

    return fail


def _unanswered_sql(tasks: str) -> str:
    names = f"SELECT DISTINCT name FROM ({_PARTS_SQL})"
    error = "CASE WHEN name LIKE 'm%' THEN 'ValueError: ' || name WHEN name LIKE '%t' AND task = 'pronunciation' THEN 'no reply' END"
    return f"SELECT name AS key, task, {error} AS error FROM ({names}), (SELECT unnest({tasks}) AS task)"


_TASKS_SQL = "['origin', 'description', 'pronunciation']"


@query("enrich_failed_calls", f"SELECT * FROM ({_unanswered_sql(_TASKS_SQL)}) WHERE error IS NOT NULL")
def enrich_failed_calls(t: Tables):
    provider = CallProvider(unreliable(), max_concurrent=64)
    enrich(_parts(t), "name", provider)
    return provider.failed()


@query(
    "enrich_call_figures",
    f"SELECT task, count(*) AS keys, count(*) AS calls, count(*) - count(error) AS replies, count(error) AS failed FROM ({_unanswered_sql(_TASKS_SQL)}) GROUP BY task",
)
def enrich_call_figures(t: Tables):
    provider = CallProvider(unreliable(), max_concurrent=64)
    enrich(_parts(t), "name", provider)
    return provider.figures().select("task", "keys", "calls", "replies", "failed")


@query("enrich_names", _enriched_sql(f"SELECT * FROM ({_PARTS_SQL}) ORDER BY md5('11:' || id), id LIMIT 100"))
def enrich_names_query(t: Tables):
    return enrich_names(_parts(t), RuleProvider(RULES), "random", 100, 11, key="name", draw_by="id")


@query(
    "us_national",
    """SELECT o_orderpriority AS name, o_orderstatus AS sex, CAST(round(o_totalprice) AS INTEGER) AS count,
    CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def us_national_query(t: Tables):
    path = t.scratch("births")
    births = t.orders.select("o_orderpriority", "o_orderstatus", F.round("o_totalprice").cast("int").alias("n"), F.year("o_orderdate").alias("yob"))
    write_headerless(births, path, ["yob"])
    return us_national(t.spark, path, "*.csv", r"/yob=([^/]+)/", recursive=True)


@query(
    "us_state",
    """SELECT o_orderstatus AS state, o_orderpriority[1] AS sex, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS name,
    CAST(round(o_totalprice) AS INTEGER) AS count FROM orders""",
)
def us_state_query(t: Tables):
    path = t.scratch("states")
    births = t.orders.select(
        F.col("o_orderstatus").alias("folder"),
        "o_orderstatus",
        F.left("o_orderpriority", F.lit(1)).alias("sex"),
        F.year("o_orderdate").alias("year"),
        "o_orderpriority",
        F.round("o_totalprice").cast("int").alias("n"),
    )
    write_headerless(births, path, ["folder"])
    return us_state(t.spark, path, "*.csv", recursive=True)
