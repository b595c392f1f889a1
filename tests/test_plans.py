import csv
import os
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from onomast.operators.enrich import (
    DIFFICULTIES, NEW_COLUMNS, ORIGINS, CallProvider, LookupProvider, RuleProvider, build_prompt, enrich, parse_description,
    validate_domain,
)
from onomast.plans import names as N
from onomast.plans.details import decade_series, estimate_regions, name_details, sort_records, write_details
from onomast.plans.enrichment import enrich_names, write_enriched
from onomast.plans.population import (
    POPULATION_COLUMNS, load_population, municipality_lookup, only_municipalities, place_lookup, province_lookup,
)
from onomast.sources import readers

ROOT = Path(__file__).resolve().parents[1]


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


BASE = [
    ("ANTONIO", 600, 57.1, "Male"), ("JOSE LUIS", 500, 60.2, "Male"), ("HUGO", 300, 11.0, "Male"), ("LEO", 300, 8.0, "Male"),
    ("MARÍA", 650, 48.0, "Female"), ("JUAN CARLOS", 100, 50.0, "Male"), (" JOSE ", 90, 61.0, "Male"),
    ("ARGÜELLO", 20, None, "Male"), ("NA", 5, 30.0, "Male"), (None, 5, 30.0, "Male"), ("ÁNGEL", 7, 35.0, "Male"),
    ("XYZ", None, 20.0, "Male"), ("ANA", 10, 39.9, None), ("EVA", 10, 40.0, "Male"),
]


@pytest.fixture
def base(spark):
    schema = f"`{N.NAME}` string, `{N.COUNT}` bigint, `{N.AGE}` double, `{N.GENDER}` string"
    return spark.createDataFrame(BASE, schema).repartition(3)


def test_process_names(spark, base):
    processed = N.process_names(base)
    assert processed.columns == [
        "Nombre", "Frecuencia", "Edad Media (*)", "Gender", "Is_Compound", "Percentage", "Popularity", "Character_Count", "Syllable_Count",
    ]
    found = {r["Nombre"]: r for r in processed.collect()}
    assert set(found) == {"ANTONIO", "HUGO", "LEO", " JOSE ", "ARGÜELLO", "NA", None, "ÁNGEL", "XYZ", "EVA"}
    total = 600 + 300 + 300 + 90 + 20 + 5 + 5 + 7 + 10
    assert found["HUGO"]["Percentage"] == 300 / total * 100
    assert [found[n]["Popularity"] for n in ("ANTONIO", "HUGO", "LEO", " JOSE ", "XYZ")] == [1, 2, 3, 4, 10]
    assert sorted(r["Popularity"] for r in found.values()) == list(range(1, 11))
    assert found["XYZ"]["Percentage"] is None
    assert [found[n]["Character_Count"] for n in (" JOSE ", None, "ÁNGEL")] == [6, 0, 6]
    assert [found[n]["Syllable_Count"] for n in ("ARGÜELLO", None, "HUGO")] == [3, 0, 2]


def test_both_genders(base):
    both = N.process_names(base, keep=F.lit(True))
    assert {r["Popularity"] for r in both.where("Gender = 'Female'").collect()} == {1}
    assert both.where("Nombre = 'ANA'").count() == 0


def test_young_popular_names(spark, base, tmp_path):
    names = N.process_names(base)
    chosen = [r["Nombre"] for r in N.young_popular_names(names, 40, 3).collect()]
    assert chosen == ["HUGO", "LEO", "ÁNGEL"]
    assert "EVA" not in [r["Nombre"] for r in N.young_popular_names(names).collect()]
    report = N.young_popular_report(names).first()
    assert (report["rows"], report["kept_rows"], report["kept_max_Edad Media (*)"], report["kept_compound"]) == (10, 6, 35.0, 0)
    path = tmp_path / "young"
    assert not N.write_young_popular(names, str(path), max_age=1) and not path.exists()
    assert N.write_young_popular(names, str(path), top_n=2)
    assert readers.scan_csv_strings(spark, str(path)).count() == 2


# Population and regions ----------------------------------------------------------------------------------------------

POPULATION = """ambito;provincia;municipio;sexo;nacionalidad;periodo;total
X;;;Total;Total;2024;48.000.000
X;02 Albacete;;Hombres;Total;2024;194.762
X;02 Albacete;;Total;Total;2024;390.000
X;02 Albacete;02003 Albacete;Hombres;Total;2024;85.000
X;13 Ciudad Real;;Hombres;Total;2024;245.000
X;26 Rioja, La;;Hombres;Total;2024;160.000
X;02 Albacete;;Hombres;Extranjera;2024;9.999
X;02 Albacete;;Hombres;Total;2023;1.111
X;10 Cáceres;10001 Santiago;Total;Total;2024;500
X;15 Coruña, A;15078 Santiago;Total;Total;2024;99.000
X;50 Zaragoza;;Hombres;Total;2024;
"""


@pytest.fixture
def raw(spark, tmp_path):
    (tmp_path / "population.csv").write_text(POPULATION, encoding="utf-8")
    scan = readers.scan_delimited_rename(spark, str(tmp_path / "population.csv"), POPULATION_COLUMNS)
    return readers.with_file_order(scan)


def test_load_population(raw):
    loaded = load_population(raw)
    assert loaded.count() == 9
    found = {(r["province_id"], r["municipality_id"], r["gender"]): r for r in loaded.collect()}
    assert found[(2, None, "Hombres")]["population"] == 194762 and found[(50, None, "Hombres")]["population"] is None
    assert found[(13, None, "Hombres")]["province_name"] == "Ciudad" and found[(26, None, "Hombres")]["province_name"] == "La Rioja"
    full = {r["province_id"]: r["province_name"] for r in load_population(raw, label_mode="full").collect()}
    assert full[13] == "Ciudad Real" and full[26] == "La Rioja" and full[15] == "A Coruña"


def test_place_lookups(raw):
    places = place_lookup(load_population(raw), readers.FILE_ORDER)
    assert rows(province_lookup(places), "province_key", "v0", "v2", "province_display") == [
        ("ALBACETE", 194762, 390000, "Albacete"), ("CIUDAD", 245000, None, None), ("LA RIOJA", 160000, None, None),
    ]
    assert rows(municipality_lookup(places), "municipality_key", "province_key", "v0", "v2") == [
        ("ALBACETE", "ALBACETE", 85000, None), ("SANTIAGO", "CACERES", None, 500), ("SANTIAGO", "CORUNA", None, 99000),
    ]
    assert rows(only_municipalities(places), "municipality_key", "v0", "provinces") == [
        ("ALBACETE", 85000, "Albacete"), ("SANTIAGO", None, "CACERES, CORUNA"),
    ]


def test_a_later_row_wins(spark):
    data = [("X", "02 Albacete", None, "Hombres", "Total", "2024", n, i) for i, n in enumerate(["5", "7", " ", ""])]
    raw = spark.createDataFrame(data, ", ".join(f"{c} string" for c in POPULATION_COLUMNS) + ", at int").repartition(3)
    assert province_lookup(place_lookup(load_population(raw), "at")).first()["v0"] == 7


PAYLOADS = [
    ("A", '{"regiones":[{"id":2,"val":"9,534"},{"id":"3","val":40.819}],"unidad":"‰"}'),
    ("B", '{"regiones":[{"id":null,"val":1},{"id":"x","val":1},{"val":1},{"id":2,"val":null},{"id":2,"val":"1.2,3"}]}'),
    ("C", '{"regiones":[{"id":99999,"val":5}]}'),
    ("D", '{"regiones":[{"id":3,"val":12.5}],"unidad":"%"}'),
    ("E", '{"regiones":[{"id":3,"val":2.5}],"unidad":null}'),
    ("F", '{"regiones":[{"id":26,"val":10},{"id":13,"val":10}]}'),
]


def payloads(spark, gender="Male"):
    return spark.createDataFrame([(n, gender, p) for n, p in PAYLOADS], "nombre string, gender string, payload string")


def region_map(spark, *more):
    known = [(2, "Araba/Álava"), (3, "Albacete"), (13, "Ciudad Real"), (26, "Rioja, La"), *more]
    return spark.createDataFrame(known, "region_id bigint, region_name string")


def test_estimate_provinces(spark, raw):
    def persons(label_mode, gender="Male"):
        places = place_lookup(load_population(raw, label_mode=label_mode), readers.FILE_ORDER)
        found = estimate_regions(payloads(spark, gender), region_map(spark), places, "prov", label_mode)
        return {(r["nombre"], r["region_id"]): (r["region_name"], r["persons"]) for r in found.collect()}

    first = persons("first_token")
    assert first == {
        ("A", 2): ("Araba/Álava", None), ("A", 3): ("Albacete", 7950), ("C", 99999): ("Desconocido", None),
        ("D", 3): ("Albacete", round(194762 * 0.125)), ("E", 3): ("Albacete", 2),
        ("F", 26): ("Rioja, La", None), ("F", 13): ("Ciudad Real", None),
    }
    assert {k: v for k, v in persons("full").items() if v != first[k]} == {("F", 26): ("Rioja, La", 1600), ("F", 13): ("Ciudad Real", 2450)}
    assert persons("first_token", "Female")[("A", 3)] == ("Albacete", round(390000 * 0.040819))


def test_estimate_municipalities(spark, raw):
    places = place_lookup(load_population(raw), readers.FILE_ORDER)
    data = [("A", "Male", '{"regiones":[{"id":3,"val":10},{"id":70,"val":10},{"id":71,"val":10}]}')]
    frame = spark.createDataFrame(data, "nombre string, gender string, payload string")
    found = estimate_regions(frame, region_map(spark, (70, "Santiago"), (71, "Nowhere")), places, "muni")
    assert rows(found, "region_name", "persons", "parent_region_name", "region_type") == [
        ("Albacete", 850, "Albacete", "municipio"), ("Nowhere", None, None, "municipio"), ("Santiago", None, "CACERES, CORUNA", "municipio"),
    ]


def test_wrong_gender_or_view_fails(spark, raw):
    places = place_lookup(load_population(raw), readers.FILE_ORDER)
    with pytest.raises(Exception, match="no code for the gender"):
        estimate_regions(payloads(spark, "male"), region_map(spark), places, "prov").collect()
    with pytest.raises(Exception, match="no code for the gender"):
        decade_series(payloads(spark, "x")).count()
    with pytest.raises(ValueError, match="view must be"):
        estimate_regions(payloads(spark), region_map(spark), places, "city")


def test_decade_series(spark):
    cases = [
        ("ANA", '{"values":[[3130,35973.5,null,"7"]],"ticks":["< 1930","1930-1940","1940-1950"]}'),
        ("EVA", '{"values":[[0.5,1.5,2.5]],"ticks":["a","b","c"]}'), ("LEO", "{}"), ("ZOE", '{"values":[],"ticks":[]}'),
    ]
    frame = spark.createDataFrame([(n, "Female", p) for n, p in cases], "nombre string, gender string, payload string")
    assert rows(decade_series(frame)) == [
        ("ANA-f", "ANA", "Female", "1930-1940", 35974), ("ANA-f", "ANA", "Female", "< 1930", 3130),
        ("EVA-f", "EVA", "Female", "a", 0), ("EVA-f", "EVA", "Female", "b", 2), ("EVA-f", "EVA", "Female", "c", 2),
    ]


def test_name_details(spark, raw, base, tmp_path):
    places = place_lookup(load_population(raw), readers.FILE_ORDER)
    series = spark.createDataFrame(
        [(n, g, '{"values":[[1]],"ticks":["t"]}') for n, g in (("HUGO", "Male"), ("MARÍA", "Female"), ("LEO", "Male"))],
        "nombre string, gender string, payload string",
    )
    regions = spark.createDataFrame(
        [(n, "Male", v, '{"regiones":[{"id":3,"val":10}]}') for n in ("HUGO", "LEO") for v in ("muni", "prov")],
        "nombre string, gender string, vista string, payload string",
    )
    maps = {"muni": region_map(spark), "prov": region_map(spark)}
    tables = name_details(base, series, regions, maps, places, ["hugo", ("maría", "FEMALE"), "nobody"])
    assert rows(tables["decades"], "nombre", "persons") == [("HUGO", 1), ("MARÍA", 1)]
    assert rows(tables["provincias"], "nombre", "persons") == [("HUGO", 1948)]
    assert rows(tables["municipios"], "nombre", "persons") == [("HUGO", 850)]
    assert write_details({**tables, "none": tables["decades"].limit(0)}, str(tmp_path / "d")) == ["decades", "municipios", "provincias"]
    written = readers.scan_csv_strings(spark, str(tmp_path / "d" / "details_provincias"))
    assert written.columns == [
        "nombre", "gender", "region_id", "region_name", "percentage", "unidad", "persons", "region_type", "parent_region_name",
    ]
    assert readers.scan_csv_strings(spark, str(tmp_path / "d" / "details_decades")).columns == ["nombre", "gender", "decade", "persons"]
    reported = name_details(base, series, regions, maps, places, ["hugo", "nobody", ("ana", "female")], report_missing=True)
    assert rows(reported["missing"], "wanted_name") == [("ANA",), ("NOBODY",)]
    assert write_details(reported, str(tmp_path / "m"))[-1] == "missing"
    limited = name_details(base, series, regions, maps, places, ["leo", "hugo"], limit=1)
    assert rows(limited["decades"], "nombre") == [("LEO",)]


def test_each_payload_is_read_once(spark, raw, base, tmp_path):
    """A counter in front of the payloads: details of both views and their sorted outputs take each payload once."""
    seen = {"series": spark.sparkContext.accumulator(0), "regions": spark.sparkContext.accumulator(0)}

    def counted(frame, kind):
        counter = seen[kind]

        def look(text):
            counter.add(1)
            return text

        return frame.withColumn("payload", F.udf(look).asNondeterministic()("payload"))

    names = [f"N{i}" for i in range(50)]
    places = place_lookup(load_population(raw), readers.FILE_ORDER)
    series = spark.createDataFrame([(n, "Male", '{"values":[[1,2]],"ticks":["t","u"]}') for n in names], "nombre string, gender string, payload string")
    regions = spark.createDataFrame(
        [(n, "Male", v, '{"regiones":[{"id":3,"val":10},{"id":4,"val":1}]}') for n in names for v in ("muni", "prov")],
        "nombre string, gender string, vista string, payload string",
    )
    frame = base.limit(0).unionByName(spark.createDataFrame([(n, 1, 1.0, "Male") for n in names], base.schema))
    tables = name_details(frame, counted(series, "series"), counted(regions, "regions"), {"muni": region_map(spark), "prov": region_map(spark)}, places)
    assert write_details(tables, str(tmp_path / "d")) == ["decades", "municipios", "provincias"]
    assert {k: v.value for k, v in seen.items()} == {"series": 50, "regions": 100}


# Published rows: persons of one name by decade, and rates and persons by province. Populations come from the fixtures file.
DECADES = ["< 1930", "1930-1940", "1940-1950", "1950-1960", "1960-1970", "1970-1980", "1980-1990", "1990-2000", "2000-2010", "2010-2019", "2020-2029"]
ANTONIO = [3130, 35973, 96828, 125710, 129158, 88892, 47714, 30154, 24328, 16240, 4877]
PROVINCES = [
    (2, "Araba/Álava", 9.534, 1589), (3, "Albacete", 40.819, 7950), (6, "Ávila", 19.493, 1571), (8, "Balears, Illes", 31.796, None),
    (11, "Cáceres", 25.848, 4982), (13, "Castellón/Castelló", 19.495, 5958), (14, "Ciudad Real", 32.078, None),
    (16, "Coruña, A", 20.576, None), (18, "Girona", 16.3, 6705), (27, "Rioja, La", 11.151, None), (29, "Madrid", 18.82, 63163),
    (35, "Palmas, Las", 13.696, None), (38, "Santa Cruz de Tenerife", 10.539, None), (41, "Sevilla", 49.581, 47611),
    (46, "Valencia/València", 21.565, 28583), (53, "Ourense", 33.958, 4964), (16473, "Desconocido", 25.308, None),
]


def male_population(spark):
    """The provinces of the fixtures file as a population table, and those without a figure there with any figure."""
    lines = re.findall(r"^\| (\d+) \| ([^|]+) \| (\d+) \| \d+-\d+ \|$", (ROOT / "FIXTURES.md").read_text(encoding="utf-8"), re.M)
    several = ["Balears, Illes", "Ciudad Real", "Coruña, A", "Rioja, La", "Palmas, Las", "Santa Cruz de Tenerife"]
    places = [(name, int(p)) for _, name, p in lines] + [(name, 100000) for name in several]
    data = [("X", f"{i:02d} {name}", "", "Hombres", "Total", "2024", f"{p:,}".replace(",", "."), i) for i, (name, p) in enumerate(places)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in POPULATION_COLUMNS) + ", at int")


def published(spark, wanted, label_mode):
    """Estimates for rows of (name, id, region, rate) by way of landed payloads."""
    by_name = {}
    for name, id, _, rate in wanted:
        by_name.setdefault(name, []).append(f'{{"id":{id},"val":"{str(rate).replace(".", ",")}"}}')
    data = [(n, "Male", f'{{"regiones":[{",".join(r)}],"unidad":"‰"}}') for n, r in by_name.items()]
    frame = spark.createDataFrame(data, "nombre string, gender string, payload string")
    known = {(id, region) for _, id, region, _ in wanted if region != "Desconocido"}
    regions = spark.createDataFrame(sorted(known), "region_id bigint, region_name string")
    places = place_lookup(load_population(male_population(spark), label_mode=label_mode), "at")
    return sort_records(estimate_regions(frame, regions, places, "prov", label_mode))


def test_published_provinces(spark):
    found = published(spark, [("ANTONIO", id, region, rate) for id, region, rate, _ in PROVINCES], "first_token").collect()
    assert [(r["region_id"], r["region_name"], r["percentage"], r["persons"]) for r in found] == PROVINCES
    assert {r["parent_region_name"] == r["region_name"] for r in found} == {True}
    full = published(spark, [("ANTONIO", id, region, rate) for id, region, rate, _ in PROVINCES], "full").collect()
    assert [r["region_name"] for r in full if r["persons"] is None] == ["Desconocido"]


def test_published_decades(spark):
    payload = f'{{"values":[{ANTONIO}],"ticks":[{",".join(chr(34) + d + chr(34) for d in DECADES)}]}}'
    frame = spark.createDataFrame([("ANTONIO", "Male", payload)], "nombre string, gender string, payload string")
    found = {r["decade"]: r["persons"] for r in decade_series(frame).collect()}
    assert found == dict(zip(DECADES, ANTONIO)) and sum(found.values()) == 603004


@pytest.mark.skipif("PUBLISHED_DIR" not in os.environ, reason="set PUBLISHED_DIR to a folder with the published tables")
def test_all_published_rows(spark):
    folder = Path(os.environ["PUBLISHED_DIR"])
    with open(folder / "details_provincias.csv", encoding="utf-8") as f:
        wanted = list(csv.DictReader(f))
    asked = [(r["nombre"], r["region_id"], r["region_name"], float(r["percentage"])) for r in wanted]
    asked = [(n, int(i), region, rate) for n, i, region, rate in asked]
    expected = Counter((n, i, region, rate, int(float(r["persons"])) if r["persons"] else None) for (n, i, region, rate), r in zip(asked, wanted))
    columns = ("nombre", "region_id", "region_name", "percentage", "persons")
    assert Counter(rows(published(spark, asked, "first_token"), *columns)) == expected and sum(expected.values()) == 159
    full = published(spark, asked, "full").where("persons is null")
    assert {r["region_name"] for r in full.collect()} == {"Desconocido"} and full.count() == 3
    with open(folder / "details_decades.csv", encoding="utf-8") as f:
        decades = [(r["nombre"], r["decade"], int(r["persons"])) for r in csv.DictReader(f)]
    data = []
    for name in dict.fromkeys(n for n, _, _ in decades):
        mine = [(d, p) for n, d, p in decades if n == name]
        data.append((name, "Male", f'{{"values":[{[p for _, p in mine]}],"ticks":[{",".join(chr(34) + d + chr(34) for d, _ in mine)}]}}'))
    series = decade_series(spark.createDataFrame(data, "nombre string, gender string, payload string"))
    assert rows(series, "nombre", "decade", "persons") == sorted(decades, key=str)


# Enrichment ----------------------------------------------------------------------------------------------------------

REPLIES = [
    ("ok", '{"origin":"Vasco"}', "*Ok* es **un** nombre", '{"spanish":"muy fácil","foreign":"difícil","explanation":"rr «ok»"}'),
    ("failed", None, None, None),
    ("broken", "no", "", '{"spanish"'),
    ("odd", '{"origin":"Marciano"}', "x" * 501, "{}"),
    ("null", '{"origin":null}', "y" * 500, '{"spanish":"muy difícil","foreign":"fácil","explanation":null}'),
]


def answered(spark, provider, extra=()):
    keys = [r[0] for r in REPLIES] + list(extra)
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, key string").repartition(3)
    return enrich(df, "key", provider)


EXPECTED = {
    "ok": ("Vasco", "Ok es un nombre", "muy fácil", "difícil", "rr Ok"),
    "failed": ("Otro", "Nombre de origen Otro.", "fácil", "difícil", "Sin información."),
    "broken": ("Otro", "Nombre de origen Otro.", "fácil", "difícil", "Sin información."),
    "odd": ("Marciano", "x" * 497 + "...", "fácil", "difícil", ""),
    "null": ("Otro", "y" * 500, "fácil", "difícil", "Sin información."),
}


def test_lookup_provider(spark):
    table = spark.createDataFrame(REPLIES, "key string, origin_raw string, description_raw string, pronunciation_raw string")
    found = answered(spark, LookupProvider(table), extra=["ok", "unknown", None])
    assert found.columns == ["id", "key", *NEW_COLUMNS] and found.count() == 8
    got = {(r["id"], r["key"]): tuple(r[c] for c in NEW_COLUMNS) for r in found.collect()}
    assert {k: v for (i, k), v in got.items() if i < 5} == EXPECTED
    assert got[(5, "ok")] == EXPECTED["ok"] and got[(6, "unknown")] == EXPECTED["failed"] and got[(7, None)] == EXPECTED["failed"]
    outside = validate_domain(found, "Family_Origin", ORIGINS)
    assert rows(outside) == [("Marciano", 1)]


def test_called_provider(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def answer(task, name, prompt):
        with open(log / f"{task}-{name}", "a") as f:
            f.write(".")
        if task != "origin":
            assert ("Vasco" if name == "ok" else "Marciano" if name == "odd" else "Otro") in prompt
        row = next(r for r in REPLIES if r[0] == name)
        reply = row[1 + ["origin", "description", "pronunciation"].index(task)]
        if reply is None:
            raise RuntimeError("no reply")
        return reply

    found = answered(spark, CallProvider(answer, max_concurrent=2), extra=["ok", "ok"])
    got = {r["key"]: tuple(r[c] for c in NEW_COLUMNS) for r in found.collect()}
    assert got == EXPECTED and found.count() == 7
    calls = {p.name: len(p.read_text()) for p in log.iterdir()}
    assert len(calls) == 15 and set(calls.values()) == {1}


def test_calls_at_a_time():
    for wanted, cores, split in ((2, 8, (2, 1)), (0, 8, (1, 1)), (8, 8, (8, 1)), (300, 100, (100, 3)), (300, 2, (2, 150))):
        assert CallProvider(str, wanted).split(cores) == split


def test_replies_in_a_folder_are_not_asked_for_again(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def answer(task, name, prompt):
        if name == "late" and not (log / "ready").exists():
            return None
        with open(log / f"{task}-{name}", "a") as file:
            file.write("x")
        return '{"origin":"Vasco"}' if task == "origin" else "x"

    names = spark.createDataFrame([("ana",), ("eva",), ("late",), (None,)], "key string")
    provider = CallProvider(answer, max_concurrent=2, folder=str(tmp_path / "replies"))
    first = {r["key"]: r["Family_Origin"] for r in enrich(names, "key", provider).collect()}
    assert first == {"ana": "Vasco", "eva": "Vasco", "late": "Otro", None: "Vasco"}
    (log / "ready").write_text("")
    again = enrich(enrich(names, "key", provider), "key", provider)
    assert again.columns == ["key", *NEW_COLUMNS] and {r["Family_Origin"] for r in again.collect()} == {"Vasco"}
    assert all(len(p.read_text()) == 1 for p in log.iterdir() if p.name != "ready")


def test_a_killed_task_costs_one_batch_at_most(spark, tmp_path):
    """The worker dies in the middle of the names; the next run asks again for what its batch had not committed."""
    log = tmp_path / "calls"
    log.mkdir()

    def answer(task, name, prompt):
        with open(log / f"{task}-{name}", "a") as file:
            file.write("x")
        if len(list(log.iterdir())) == 25 and not (log.parent / "killed").exists():
            (log.parent / "killed").write_text("")
            os._exit(1)
        return '{"origin":"Vasco"}' if task == "origin" else "x"

    names = spark.createDataFrame([(f"n{i:02}",) for i in range(40)], "key string")
    provider = CallProvider(answer, max_concurrent=2, folder=str(tmp_path / "replies"), batch_keys=5)
    with pytest.raises(Exception):
        enrich(names, "key", provider).collect()
    before = {p.name for p in log.iterdir()}
    committed = provider.logs[f"{tmp_path}/replies/origin"].known().count()
    assert len(before) >= 25 and 10 <= committed < 25
    assert {r["Family_Origin"] for r in enrich(names, "key", provider).collect()} == {"Vasco"}
    calls = {p.name: len(p.read_text()) for p in log.iterdir()}
    assert len(calls) == 120 and set(calls.values()) <= {1, 2}
    twice = [name for name, n in calls.items() if n == 2]
    assert len(twice) == len(before) - committed <= 12 and all(name.startswith("origin-") for name in twice)


def test_failed_calls_are_listed_and_only_they_are_asked_again(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def answer(task, name, prompt):
        with open(log / f"{task}-{name}", "a") as file:
            file.write("x")
        if not (log.parent / "ready").exists():
            if name == "down":
                raise TimeoutError("too late")
            if name == "mute" and task == "pronunciation":
                return None
        return '{"origin":"Vasco"}' if task == "origin" else "x"

    names = spark.createDataFrame([("ana",), ("down",), ("mute",), (None,)], "key string")
    provider = CallProvider(answer, max_concurrent=2, folder=str(tmp_path / "replies"))
    first = {r["key"]: (r["Family_Origin"], r["Name_Description"]) for r in enrich(names, "key", provider).collect()}
    assert first["down"] == ("Otro", "Nombre de origen Otro.") and first["mute"] == ("Vasco", "x")
    late = "TimeoutError: too late"
    assert rows(provider.failed()) == sorted([("down", t, late) for t in ("origin", "description", "pronunciation")] + [("mute", "pronunciation", "no reply")])
    figures = {r["task"]: r for r in provider.figures().collect()}
    assert {t: (r["keys"], r["calls"], r["replies"], r["failed"]) for t, r in figures.items()} == {
        "origin": (4, 4, 3, 1), "description": (4, 4, 3, 1), "pronunciation": (4, 4, 2, 2),
    }
    assert all(r["calls_per_minute"] is None or r["calls_per_minute"] > 0 for r in figures.values())
    (tmp_path / "ready").write_text("")
    enrich(names, "key", provider)
    assert provider.failed().isEmpty()
    again = {p.name for p in log.iterdir() if len(p.read_text()) == 2}
    assert again == {"origin-down", "description-down", "pronunciation-down", "pronunciation-mute"}


def test_repeated_replies_do_not_multiply_rows(spark):
    table = spark.createDataFrame([("ana", f'{{"origin":"{o}"}}', "d", "{}", i) for i, o in enumerate(["Vasco", "Griego", "Chino"])],
        "key string, origin_raw string, description_raw string, pronunciation_raw string, at int")
    (row,) = enrich(spark.createDataFrame([("ana",)], "key string"), "key", LookupProvider(table, order="at")).collect()
    assert row["Family_Origin"] == "Chino"


def test_rules(spark):
    found = answered(spark, RuleProvider([("^o", "Griego")]))
    assert {r["key"]: r["Family_Origin"] for r in found.collect()} == {
        "ok": "Griego", "odd": "Griego", "failed": "Desconocido", "broken": "Desconocido", "null": "Desconocido",
    }
    assert validate_domain(found, "Pronunciation_Spanish", DIFFICULTIES).isEmpty()
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_prompts(values):
    made = values(lambda n: build_prompt("description", n, F.lit("Vasco")), ["ANA", None])
    assert "«ANA»" in made[0] and "Vasco" in made[0] and "{" not in made[0] and "«»" in made[1]
    asked = values(lambda n: build_prompt("origin", n), ["ANA"])[0]
    assert all(o in asked for o in ORIGINS)


def test_description(values):
    def parse(raw, name):
        return parse_description(raw, name, F.lit("Vasco"))

    cases = [("_ANA_ es 'ana'", "ana"), (None, "ana"), ("", "vasco")]
    assert values(parse, cases, "string,string") == ["Ana es 'Ana'", "Nombre de origen Vasco.", "Nombre de origen Vasco."]


def test_enrich_names(spark, base, tmp_path):
    enriched = enrich_names(base.where("Nombre is not null"), RuleProvider([]), "random", 4, 3)
    assert enriched.count() == 4 and enriched.columns == base.columns + NEW_COLUMNS
    assert not write_enriched(enriched.limit(0), str(tmp_path / "e"))
    assert write_enriched(enriched, str(tmp_path / "e"))
    assert readers.scan_csv_strings(spark, str(tmp_path / "e"), multiline=True).columns == enriched.columns
