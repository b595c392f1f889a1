"""Text functions over whole documents, and replies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import replies, text
from ..operators.enrich import FAILED_PRONUNCIATION, MISSING_PRONUNCIATION, PROMPTS, build_prompt, parse_origin
from .registry import Tables, query


def _on_text(function):
    return lambda t: t.spread("documents").select("doc_id", function(F.col("text")).alias("result"))


def _sql(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS result FROM documents"


_SYLLABLES = "CAST(len(regexp_extract_all(lower(text), '[aeiouáéíóúü]+')) AS INTEGER)"
_NORMAL = "nullif(trim(regexp_replace(upper(strip_accents(replace(text, 'ß', 'ss'))), '[^A-Z0-9]+', ' ', 'g')), '')"
_CUT = "CASE WHEN length({0}) > 500 THEN {0}[:497] || '...' ELSE {0} END"


def _unmarked(c: str) -> str:
    for pattern in (r"\*\*([^*]+)\*\*", r"\*([^*]+)\*", "__([^_]+)__", "_([^_]+)_"):
        c = rf"regexp_replace({c}, '{pattern}', '\1', 'g')"
    return c


def _titled(c: str, term: str) -> str:
    """Whole words of a variable term. A mark behind each blank or sign lets a match start where another one ended."""
    marked = rf"regexp_replace({c}, '([^\p{{L}}\p{{N}}_])', '\1' || chr(1), 'g')"
    pattern = rf"'(?i)(^|\x01)(' || {term} || ')([^\p{{L}}\p{{N}}_]|$)'"
    form = rf"'\1' || upper({term}[1]) || lower({term}[2:]) || '\3'"
    return f"replace(regexp_replace({marked}, {pattern}, {form}, 'g'), chr(1), '')"


def _scrubbed(c: str) -> str:
    spaced = rf"regexp_replace(replace({c}, chr(34), chr(39)), '[\s\x1c-\x1f\x85\xa0]+', ' ', 'g')"
    return rf"trim(regexp_replace({spaced}, '[^\p{{L}}\p{{N}}_ .,;:!?()\-'']', '', 'g'))"


query("char_count", _sql("CAST(length(text) AS INTEGER)"))(_on_text(text.char_count))
query("syllable_count", _sql(_SYLLABLES))(_on_text(text.syllable_count))
query("scalar_udf", "SELECT lang, CAST(sum(length(text)) AS BIGINT) AS characters, "
    f"CAST(sum({_SYLLABLES}) AS BIGINT) AS syllables FROM documents GROUP BY 1")(
    lambda t: t.spread("documents").groupBy("lang").agg(
        F.sum(text.char_count(F.col("text"))).alias("characters"), F.sum(text.syllable_count(F.col("text"))).alias("syllables")
    )
)
query("is_compound", _sql(r"regexp_matches(text, '[^\s]\s+[^\s]')"))(_on_text(text.is_compound))
query("normalize_label", _sql(_NORMAL))(_on_text(text.normalize_label))
query("truncate_ellipsis", _sql(_CUT.format("text")))(_on_text(text.truncate_ellipsis))
query("strip_markdown", _sql(_unmarked("text")))(_on_text(text.strip_markdown))
query("scrub_text", _sql(_scrubbed("text")))(_on_text(text.scrub_text))


@query("titlecase_terms", _sql(_titled(_titled("text", "lang"), "'the'")))
def titlecase_terms(t: Tables):
    terms = F.concat("lang", F.lit("  thE "))
    return t.spread("documents").select("doc_id", text.titlecase_terms(F.col("text"), terms).alias("result"))


@query("clean_text", _sql(_scrubbed(_titled(_unmarked("text"), "lang"))))
def clean_text(t: Tables):
    return t.spread("documents").select("doc_id", text.clean_text(F.col("text"), F.col("lang")).alias("result"))


@query(
    "default_if_falsy",
    _sql("CASE WHEN lang IN ('en', 'fr') THEN 'Nombre de origen ' || source || '.' ELSE text END"),
)
def default_if_falsy(t: Tables):
    given = F.when(F.col("lang") == "en", "").when(F.col("lang") != "fr", F.col("text"))
    default = F.format_string("Nombre de origen %s.", "source")
    return t.documents.select("doc_id", text.default_if_falsy(given, default).alias("result"))


@query(
    "build_key",
    "SELECT p_partkey, replace(upper(p_name), ' ', '_') || '-' || lower(p_type[1]) AS k FROM part",
)
def build_key(t: Tables):
    return t.part.select("p_partkey", text.build_key(F.concat(F.lit(" "), "p_name"), F.col("p_type")).alias("k"))


@query(
    "safe_identifier",
    """SELECT s_suppkey, upper(replace(s_name, '#', '_')) || '_' || CASE WHEN s_acctbal < 0 THEN 'x' ELSE 's' END AS k FROM supplier""",
)
def safe_identifier(t: Tables):
    name = F.concat(F.lit("¡"), F.replace("s_name", F.lit("#"), F.lit(" # ")), F.lit("!"))
    group = F.when(F.col("s_acctbal") >= 0, F.col("s_name"))
    return t.supplier.select("s_suppkey", text.safe_identifier(name, group).alias("k"))


@query(
    "clean_label",
    """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'La Rioja' WHEN 'PROMO' THEN p_name
    WHEN 'LARGE' THEN 'a, b, ' || p_name ELSE p_name || ' ' || p_brand END AS label FROM part""",
)
def clean_label(t: Tables):
    kind = F.col("p_type")
    label = (
        F.when(kind == "SMALL", " Rioja,")
        .when(kind == "PROMO", F.concat("p_name", F.lit(",, ")))
        .when(kind == "LARGE", F.concat(F.lit("a, b, "), "p_name"))
        .otherwise(F.concat("p_brand", F.lit(", "), "p_name"))
    )
    return t.part.select("p_partkey", text.clean_label(label).alias("label"))


@query("element_udf", """SELECT s_suppkey, 'Los ' || s_name AS label FROM supplier""")
def element_udf(t: Tables):
    return t.supplier.select("s_suppkey", text.clean_label(F.concat("s_name", F.lit(", Los"))).alias("label"))


def _prompt_sql(task: str, name: str, origin: str) -> str:
    quoted = PROMPTS[task].replace("'", "''")
    return "'" + quoted.replace("{name}", f"' || {name} || '").replace("{origin}", f"' || {origin} || '") + "'"


@query(
    "build_prompt",
    f"""SELECT p_partkey, {_prompt_sql("origin", "p_name", "p_brand")} AS origin,
    {_prompt_sql("description", "p_name", "p_brand")} AS description,
    {_prompt_sql("pronunciation", "p_name", "p_brand")} AS pronunciation FROM part""",
)
def build_prompt_query(t: Tables):
    return t.part.select(
        "p_partkey", *[build_prompt(task, F.col("p_name"), F.col("p_brand")).alias(task) for task in PROMPTS]
    )


@query(
    "json_default",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'Otro' WHEN 'view' THEN 'Otro' ELSE props->>'$.k' END AS k,
    CASE event_type WHEN 'error' THEN 'Otro' ELSE event_type END AS origin FROM events""",
)
def json_default(t: Tables):
    kind = F.col("event_type")
    props = F.when(kind == "error", None).when(kind == "view", F.concat(F.lit("["), "props")).otherwise(F.col("props"))
    reply = F.when(kind == "error", "{'origin':'X'}").otherwise(F.to_json(F.struct(kind.alias("origin"))))
    return t.events.select(
        "event_id", replies.json_default(props, "k", "Otro").alias("k"), parse_origin(reply).alias("origin")
    )


@query(
    "json_all_or_nothing",
    """SELECT event_id,
    CASE event_type WHEN 'click' THEN 'muy fácil' ELSE 'fácil' END AS spanish,
    CASE event_type WHEN 'signup' THEN 'muy difícil' ELSE 'difícil' END AS "foreign",
    CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'signup' THEN '' ELSE 'Sin información.' END AS explanation
    FROM events""",
)
def json_all_or_nothing(t: Tables):
    kind = F.col("event_type")
    reply = (
        F.when(kind == "click", F.concat(F.lit('{"spanish":"muy fácil","explanation":"'), "user_id", F.lit('"}')))
        .when(kind == "signup", '{"foreign":"muy difícil","spanish":null}')
        .when(kind == "view", '{"spanish":"muy fácil","explanation":null}')
        .when(kind == "error", '{"spanish":"muy')
    )
    parsed = replies.json_all_or_nothing(reply, "explanation", FAILED_PRONUNCIATION, MISSING_PRONUNCIATION)
    return t.spread("events").select("event_id", parsed.alias("said")).select(
        "event_id", "said.spanish", "said.foreign", "said.explanation"
    )
