from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from onomast.plans.names import build_names_base
from onomast.plans.national import convert_national, convert_state, us_national, us_state
from onomast.sources import readers, writers
from onomast.sources.scratch import release_scratch, scratch_path, stage


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_national_files(spark, tmp_path):
    (tmp_path / "yob1880.txt").write_text("Mary,F,7065\nNA,F,5\n")
    (tmp_path / "yob1881.txt").write_text("Mary,F,6919\n")
    (tmp_path / "readme.txt").write_text("no data\n")
    found = us_national(spark, str(tmp_path))
    assert found.dtypes == [("name", "string"), ("sex", "string"), ("count", "int"), ("year", "int")]
    assert rows(found) == [("Mary", "F", 6919, 1881), ("Mary", "F", 7065, 1880), ("NA", "F", 5, 1880)]


def test_conversion(spark, tmp_path):
    landed, out = tmp_path / "landed", tmp_path / "out"
    landed.mkdir()
    (landed / "yob1880.txt").write_text("Mary,F,7065\n")
    (landed / "AK.TXT").write_text("AK,F,1910,Mary,14\n")
    convert_national(spark, str(landed), f"{out}/n", ["year"])
    convert_state(spark, str(landed), f"{out}/s")
    assert rows(spark.read.parquet(f"{out}/n")) == [("Mary", "F", 7065, 1880)]
    assert rows(spark.read.parquet(f"{out}/s")) == [("AK", "F", 1910, "Mary", 14)]


def test_state_files(spark, tmp_path):
    (tmp_path / "AK.TXT").write_text("AK,F,1910,Mary,14\n")
    (tmp_path / "AL.TXT").write_text("AL,M,1911,Bob,8\n")
    (tmp_path / "notes.txt").write_text("x\n")
    assert rows(us_state(spark, str(tmp_path))) == [("AK", "F", 1910, "Mary", 14), ("AL", "M", 1911, "Bob", 8)]


def test_bad_value_and_bad_year_fail(spark, tmp_path):
    (tmp_path / "yob1880.txt").write_text("Bob,M,x\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        us_national(spark, str(tmp_path)).collect()
    other = tmp_path / "other"
    other.mkdir()
    (other / "yobold.txt").write_text("Bob,M,1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        us_national(spark, str(other)).collect()


def test_no_files(spark, tmp_path):
    (tmp_path / "readme.md").write_text("x")
    with pytest.raises(ValueError):
        us_national(spark, str(tmp_path))
    with pytest.raises(ValueError):
        us_state(spark, str(tmp_path / "nowhere"))


def test_require_nonempty(spark):
    assert readers.require_nonempty(spark.range(1), "x").count() == 1
    with pytest.raises(ValueError, match="x is empty"):
        readers.require_nonempty(spark.range(0), "x")


def test_sheets(spark, tmp_path):
    def sheet(name, lines, preamble=6):
        folder = tmp_path / name
        folder.mkdir()
        for i, part in enumerate(lines):
            text = [f"note {n}" for n in range(preamble)] + ["Nombre,Frecuencia,Edad Media (*)"] + part
            (folder / f"{name}{i}.csv").write_text("\n".join(text) + "\n")

    sheet("Hombres", [["ANTONIO,600,57.1", '"A, B",5,1.0'], ["LEO,300,8.0"], []])
    sheet("Mujeres", [["NA,650,48.0"]])
    found = build_names_base(spark, f"{tmp_path}/*")
    assert rows(found) == [("A, B", 5, 1.0, "Male"), ("ANTONIO", 600, 57.1, "Male"), ("LEO", 300, 8.0, "Male"), ("NA", 650, 48.0, "Female")]


def test_sheet_in_several_splits(spark, tmp_path):
    (tmp_path / "Hombres.csv").write_text("\n".join(["note"] * 6 + ["header"] + [f"N{i},{i},1.5" for i in range(3000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = build_names_base(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 3
        assert found.agg(F.count("*"), F.sum("Frecuencia")).first()[:] == (3000, 3000 * 2999 // 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_round_trip(spark, tmp_path):
    data = [("NA", '"q", x\ny'), (" JOSE ", "NULL"), ("á", None)]
    df = spark.createDataFrame(data, "a string, b string")
    path = str(tmp_path / "t")
    writers.write_csv(df, path)
    assert rows(readers.scan_csv(spark, path, df.schema, multiline=True)) == sorted(data, key=str)
    strings = readers.scan_csv_strings(spark, path, multiline=True)
    assert strings.dtypes == [("a", "string"), ("b", "string")] and rows(strings) == sorted(data, key=str)
    part = next(p for p in (tmp_path / "t").glob("part*") if "NA" in p.read_text())
    assert '"""q"", x\ny"' in part.read_text() and '"NA"' not in part.read_text()


def test_records(spark, tmp_path):
    df = spark.createDataFrame([("k", "ANA", 2)], "nombre_id string, nombre string, n int")
    path = tmp_path / "out"
    assert not writers.write_records(df.where("n > 5"), str(path)) and not path.exists()
    assert writers.write_records(df, str(path))
    assert readers.scan_csv_strings(spark, str(path)).columns == ["nombre", "n"]
    assert writers.write_records(df, str(path), drop=(), schema=StructType.fromDDL("n int, nombre string"))
    assert readers.scan_csv_strings(spark, str(path)).columns == ["n", "nombre"]


def test_parquet_is_zstd_and_partitioned(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.createDataFrame([(1, 1880), (2, 1881)], "n int, year int")
    writers.write_parquet(df, str(tmp_path / "p"), ["year"])
    files = list((tmp_path / "p").glob("year=*/*.parquet"))
    assert len(files) == 2 and pq.ParquetFile(files[0]).metadata.row_group(0).column(0).compression == "ZSTD"
    plan = spark.read.parquet(str(tmp_path / "p")).where("year = 1880")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


MAP = """<svg xmlns="http://www.w3.org/2000/svg"><g><path class="reg id_2" title=" Araba/Álava " d="M0"/>
<path class="id_x" title="bad id"/><path title="no class"/><path class="id_7"/><path class="" title="e"/>
<g><path class="id_3 z id_9" title="old"/><path class="id_3" title="Albacete"/></g><path class="a id_x id_5" title="first counts"/></g></svg>"""


def test_map_ids(spark, tmp_path):
    (tmp_path / "m.svg").write_text(MAP, encoding="utf-8")
    assert rows(readers.scan_xml_ids(spark, str(tmp_path / "m.svg"))) == [(2, "Araba/Álava"), (3, "Albacete")]


def test_json_payloads(spark, tmp_path):
    cases = ['{"values":[[3130,35973.5,null,"7"]],"ticks":["a","b","c"]}', "{}", '{"values":[],"ticks":[]}']
    path = str(tmp_path / "p")
    spark.createDataFrame([(str(i), c) for i, c in enumerate(cases)], "nombre string, payload string").write.json(path)
    series = readers.parse_series(readers.scan_json(spark, path, "nombre string, payload string")).orderBy("nombre").collect()
    assert [(r["ticks"], r["values"]) for r in series] == [(["a", "b", "c"], ["3130", "35973.5", None, "7"]), ([], []), ([], [])]
    units = ['{"unidad":"%"}', '{"unidad":null}', "{}"]
    found = readers.parse_regions(spark.createDataFrame([(i, u) for i, u in enumerate(units)], "i int, payload string"))
    assert [r["unidad"] for r in found.orderBy("i").collect()] == ["%", None, "‰"]
    with pytest.raises(Exception):
        readers.parse_series(spark.createDataFrame([("{",)], "payload string")).collect()


def test_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\nx,1\nx,2\n")
    (tmp_path / "b.csv").write_text("k,v\nx,3\n" + "y,4\n" * 500)
    scan = readers.with_file_order(readers.scan_csv(spark, str(tmp_path), "k string, v int"))
    last = scan.where("k = 'x'").groupBy("k").agg(F.max_by("v", readers.FILE_ORDER), F.min_by("v", readers.FILE_ORDER)).first()
    assert last[1:] == (3, 1)


def test_scratch(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    staged = stage(spark.range(10).withColumn("p", F.spark_partition_id()), "t")
    assert staged.count() == 10 and staged.dtypes == [("id", "bigint"), ("p", "int")]
    file = Path(urlparse(staged.inputFiles()[0]).path)
    assert file.exists() and release_scratch(spark) >= 1 and not file.parent.exists()
    assert release_scratch(spark) == 0


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Cluster, "x")
    Cluster.sparkContext.master = "local[2]"
    assert "onomast" in scratch_path(Cluster, "x")


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Gender,Nombre,n\nMale,ANA,1\n")
    found = readers.scan_csv(spark, str(tmp_path), "Nombre string, n int")
    assert [tuple(r) for r in found.collect()] == [("ANA", 1)]
    with pytest.raises(ValueError, match="no column Edad"):
        readers.scan_csv(spark, str(tmp_path), "Nombre string, Edad int")
    (tmp_path / "b.csv").write_text("Nombre,Gender,n\nEVA,Female,2\n")
    with pytest.raises(Exception):
        readers.scan_csv(spark, str(tmp_path), "Nombre string, n int").collect()


def test_ragged_rows_are_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        readers.scan_csv_strings(spark, str(tmp_path)).select("a").collect()


def test_headerless_quotes_come_back(spark, tmp_path):
    data = [('say "hi"', 1), ("a, b", 2), ("back\\slash", 3), (" blank ", 4)]
    frame = spark.createDataFrame(data, "s string, n int")
    writers.write_headerless(frame, str(tmp_path / "x"))
    assert rows(readers.scan_headerless(spark, str(tmp_path / "x"), frame.schema)) == sorted(data, key=str)
