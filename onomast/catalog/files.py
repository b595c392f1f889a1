"""Scans and sinks: a table is written in the format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.names import AGE, COUNT, NAME, build_names_base
from ..plans.population import POPULATION_COLUMNS
from ..sources import readers, writers
from .registry import Tables, query
from .shapes import NAMES_SQL, province_payloads, series_payloads, write_sheets


@query("scan_csv", "SELECT * FROM part")
def scan_csv(t: Tables):
    path = t.scratch("csv")
    writers.write_csv(t.part, path)
    return readers.scan_csv(t.spark, path, t.part.schema)


@query(
    "scan_csv_strings",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
    CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier""",
)
def scan_csv_strings(t: Tables):
    path = t.scratch("csv")
    writers.write_csv(t.supplier, path)
    return readers.scan_csv_strings(t.spark, path)


@query("scan_headerless_typed", "SELECT * FROM customer")
def scan_headerless_typed(t: Tables):
    path = t.scratch("headerless")
    writers.write_headerless(t.customer, path)
    return readers.scan_headerless(t.spark, path, t.customer.schema)


@query("scan_multi_file", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_multi_file(t: Tables):
    path = t.scratch("many")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderpriority").alias("folder"))
    writers.write_headerless(orders, path, ["folder"])
    return readers.scan_headerless(t.spark, path, orders.drop("folder").schema, "*.csv", recursive=True)


@query("path_derived_column", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def path_derived_column(t: Tables):
    path = t.scratch("years")
    orders = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("yob"))
    writers.write_headerless(orders, path, ["yob"])
    scan = readers.scan_headerless(t.spark, path, orders.drop("yob").schema, "*.csv", recursive=True)
    return readers.with_path_int(scan, "year", r"/yob=(\d+)/")


@query("require_inputs", "SELECT p_partkey, p_size FROM part")
def require_inputs(t: Tables):
    return readers.require_inputs(t.part, t.folder).select("p_partkey", "p_size")


@query("require_nonempty", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 0")
def require_nonempty(t: Tables):
    poor = t.customer.where("c_acctbal < 0").select("c_custkey", "c_mktsegment")
    return readers.require_nonempty(poor, "The table of customers in debt")


@query(
    "scan_delimited_rename",
    """SELECT 'X' AS ambito, c_nationkey || ' place' AS province_raw, NULL::VARCHAR AS municipality_raw,
    c_mktsegment AS gender, 'Total' AS nationality, '2024' AS period, CAST(c_custkey AS VARCHAR) AS population FROM customer""",
)
def scan_delimited_rename(t: Tables):
    path = t.scratch("semicolons")
    rows = t.customer.select(
        F.lit("X").alias("a"),
        F.concat("c_nationkey", F.lit(" place")).alias("b"),
        F.lit(None).cast("string").alias("c"),
        F.col("c_mktsegment").alias("d"),
        F.lit("Total").alias("e"),
        F.lit("2024").alias("f"),
        F.col("c_custkey").alias("g"),
    )
    writers.write_csv(rows, path, sep=";")
    return readers.scan_delimited_rename(t.spark, path, POPULATION_COLUMNS)


@query("scan_tagged_sheets", NAMES_SQL)
def scan_tagged_sheets(t: Tables):
    return build_names_base(t.spark, write_sheets(t))


_BROKEN_SQL = "replace(c_name || chr(10) || c_nationkey || ' \"' || c_mktsegment || '\", x', 'o', chr(10))"


@query(
    "scan_tagged_sheets_breaks",
    f"""SELECT {_BROKEN_SQL} AS "Nombre", c_custkey AS "Frecuencia", CAST(c_nationkey AS DOUBLE) AS "Edad Media (*)",
    CASE WHEN c_acctbal < 0 THEN 'Female' ELSE 'Male' END AS "Gender" FROM customer""",
)
def scan_tagged_sheets_breaks(t: Tables):
    """Cells with line breaks, quotes and commas, in files that are read in splits."""
    folder = t.scratch("sheets")
    text = F.concat("c_name", F.lit("\n"), "c_nationkey", F.lit(' "'), "c_mktsegment", F.lit('", x'))
    cells = [F.replace(text, F.lit("o"), F.lit("\n")).alias(NAME), F.col("c_custkey").alias(COUNT), F.col("c_nationkey").cast("double").alias(AGE)]
    for label, chosen in (("Hombres", "c_acctbal >= 0"), ("Mujeres", "c_acctbal < 0")):
        writers.write_csv(t.customer.where(chosen).select(*cells), f"{folder}/{label}")
    return build_names_base(t.spark, f"{folder}/*", skip=0, multiline=True)


@query(
    "scan_json_series",
    """SELECT ' order ' || l_orderkey AS nombre, CASE l_linestatus WHEN 'O' THEN 'Male' ELSE 'Female' END AS gender,
    'quantity,discount,price' AS ticks, concat_ws(',', CAST(l_quantity AS VARCHAR),
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_discount AS VARCHAR) ELSE '?' END, CAST(l_extendedprice AS VARCHAR),
    CAST(l_tax AS VARCHAR)) AS values FROM lineitem""",
)
def scan_json_series(t: Tables):
    path = t.scratch("series")
    payloads = series_payloads(t)
    payloads.write.json(path)
    series = readers.parse_series(readers.scan_json(t.spark, path, payloads.schema))
    return series.select(
        "nombre", "gender", F.array_join("ticks", ",").alias("ticks"), F.array_join("values", ",", "?").alias("values")
    )


@query(
    "scan_json_regions",
    """SELECT c_name AS nombre, 5 AS regions, CAST(c_nationkey AS VARCHAR) AS first_id,
    replace(CAST(c_custkey / 8 AS VARCHAR), '.', ',') AS first_val,
    CASE c_mktsegment WHEN 'BUILDING' THEN '%' WHEN 'HOUSEHOLD' THEN NULL ELSE '‰' END AS unidad FROM customer""",
)
def scan_json_regions(t: Tables):
    path = t.scratch("regions")
    payloads = province_payloads(t)
    payloads.write.json(path)
    parsed = readers.parse_regions(readers.scan_json(t.spark, path, payloads.schema))
    return parsed.select(
        "nombre",
        F.size("regiones").alias("regions"),
        F.col("regiones")[0]["id"].alias("first_id"),
        F.col("regiones")[0]["val"].alias("first_val"),
        "unidad",
    )


@query("scan_xml_ids", "SELECT c_custkey AS region_id, c_name AS region_name FROM customer")
def scan_xml_ids(t: Tables):
    path = t.scratch("xml")
    shapes = t.customer.select(
        F.explode(
            F.array(
                F.struct(
                    F.concat(F.lit("shape id_"), "c_custkey", F.lit(" z")).alias("_class"),
                    F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("_title"),
                ),
                F.struct(F.lit("id_none").alias("_class"), F.col("c_name").alias("_title")),
                F.struct(F.col("c_mktsegment").alias("_class"), F.col("c_name").alias("_title")),
            )
        ).alias("shape")
    ).select("shape.*")
    shapes.write.format("xml").options(rootTag="svg", rowTag="path").save(path)
    return readers.scan_xml_ids(t.spark, path)


@query("sink_csv", "SELECT s_suppkey, ' ' || s_name || ' ' AS s_name, s_acctbal FROM supplier")
def sink_csv(t: Tables):
    path = t.scratch("csv")
    rows = t.supplier.select("s_suppkey", F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("s_name"), "s_acctbal")
    writers.write_csv(rows, path)
    return readers.scan_csv(t.spark, path, rows.schema)


@query("sink_csv_minimal_quote", "SELECT doc_id, text, lang, lang || '!' AS greeting FROM documents")
def sink_csv_minimal_quote(t: Tables):
    path = t.scratch("quoted")
    rows = t.documents.select("doc_id", "text", "lang", F.concat("lang", F.lit("!")).alias("greeting"))
    writers.write_csv(rows, path, rows_per_file=20_000)
    return readers.scan_csv(t.spark, path, rows.schema, multiline=True)


@query("sink_parquet_zstd", "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem")
def sink_parquet_zstd(t: Tables):
    path = t.scratch("zstd")
    writers.write_parquet(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag"), path)
    return t.spark.read.parquet(path)


@query("sink_records_optional", "SELECT p_partkey, p_name FROM part")
def sink_records_optional(t: Tables):
    path = t.scratch("records")
    writers.write_records(t.part.select(F.col("p_brand").alias("nombre_id"), "p_partkey", "p_name"), path)
    return readers.scan_csv(t.spark, path, "p_partkey bigint, p_name string")


@query("sink_dataclass", "SELECT p_name, p_partkey, p_size FROM part")
def sink_dataclass(t: Tables):
    path = t.scratch("records")
    schema = StructType.fromDDL("p_name string, p_partkey bigint, p_size int")
    writers.write_records(t.part, path, drop=(), schema=schema)
    return readers.scan_csv(t.spark, path, schema)
