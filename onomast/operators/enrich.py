"""Columns that an outside model answers: prompts out, replies in, typed columns with defaults."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.replies import json_all_or_nothing, json_default
from ..functions.text import clean_text, default_if_falsy, truncate_ellipsis
from ..sources.scratch import scratch_path, stage
from .joins import lookup_join
from .reply_log import ReplyLog

# The allowed origins and levels of difficulty.
ORIGINS = [
    "Africano", "Alemán", "Anglosajón", "Arameo", "Armenio", "Catalán", "Chino", "Contemporáneo", "Coreano",
    "Desconocido", "Egipcio", "Escandinavo", "Eslavo", "Español", "Francés", "Gallego", "Georgiano", "Griego",
    "Guanche", "Hawaiano", "Húngaro", "Indonesio", "Italiano", "Japonés", "Latinoamericano", "Lituano",
    "Nativo Americano", "Persa", "Portugués", "Rumano", "Sánscrito", "Turco", "Vasco", "Árabe", "Otro",
]
DIFFICULTIES = ["muy fácil", "fácil", "difícil", "muy difícil"]

# What stands in for a missing reply or field.
DEFAULT_ORIGIN = "Otro"
DEFAULT_DESCRIPTION = "Nombre de origen %s."
FAILED_PRONUNCIATION = {"spanish": "fácil", "foreign": "difícil", "explanation": "Sin información."}
MISSING_PRONUNCIATION = {"spanish": "fácil", "foreign": "difícil", "explanation": ""}

# The names of the new columns.
NEW_COLUMNS = [
    "Family_Origin",
    "Name_Description",
    "Pronunciation_Spanish",
    "Pronunciation_Foreign",
    "Pronunciation_Explanation",
]

TASKS = ("origin", "description", "pronunciation")

PROMPTS = {
    "origin": (
        "Valores posibles: "
        + "; ".join(ORIGINS)
        + '. Asigna uno de ellos al nombre «{name}» y devuélvelo como JSON, en el campo "origin". La mezcla de inglés y español '
        "cuenta como Latinoamericano; en los nombres compuestos manda la palabra de procedencia más lejana."
    ),
    "description": (
        "Escribe una nota breve y seguida, sin títulos ni listas, para una ficha del nombre «{name}», clasificado como "
        "{origin}. Debe servir a quien lo ve por primera vez y contener solo datos seguros; si hay pocos, que sea corta."
    ),
    "pronunciation": (
        "Ficha de lectura en voz alta. Nombre: «{name}». Clasificación: {origin}. Niveles posibles: "
        + ", ".join(DIFFICULTIES)
        + '. Devuelve JSON y nada más: "explanation" con una frase, "foreign" con el nivel de un lector extranjero y '
        '"spanish" con el de un lector español.'
    ),
}


def build_prompt(task: str, name: Column, origin: Column | None = None) -> Column:
    """The question of a task about a name and, but for the first task, its origin."""
    values = {"name": name, "origin": origin}
    parts = []
    for i, piece in enumerate(PROMPTS[task].split("{")):
        if i == 0:
            parts.append(F.lit(piece))
            continue
        field, rest = piece.split("}", 1)
        parts += [F.coalesce(values[field], F.lit("")), F.lit(rest)]
    return F.concat(*parts)


@dataclass
class CallProvider:
    """Answers by calling ``answer(task, name, prompt)``, which must be picklable, on the executors.

    Tasks times calls at a time in each never exceed ``max_concurrent``, however many cores the cluster has or gets. Replies are
    committed to a log after each batch of ``batch_keys`` names, so that a lost executor or driver costs at most one batch a second
    call. A call that raises or returns None has no reply; ``failed`` lists those, with their errors, and ``figures`` sums
    calls, failures and speed up. With a ``folder``, the log is kept there, and a later run only asks for what has no reply.
    """

    answer: Callable[[str, str | None, str], str | None]
    max_concurrent: int = 8
    folder: str | None = None
    batch_keys: int = 1_000
    logs: dict[str, ReplyLog] = field(default_factory=dict, init=False, repr=False)

    def split(self, cores: int) -> tuple[int, int]:
        """Number of tasks and of calls at a time in each."""
        tasks = max(1, min(cores, self.max_concurrent))
        return tasks, max(1, self.max_concurrent // tasks)

    def replies(self, asked: DataFrame, key: str, tasks: tuple[str, ...]) -> DataFrame:
        """Replace the prompts in the columns named like the tasks by the replies, which are in the log before they are used."""
        # Written, so that the names are worked out once, for the questions and for the answers.
        spark, name, asked = asked.sparkSession, "-".join(tasks), stage(asked, "asked")
        path = scratch_path(spark, name) if self.folder is None else f"{self.folder.rstrip('/')}/{name}"
        log = self.logs[path] = ReplyLog(spark, path, asked.schema[key].dataType, tasks)
        log.ask(asked, key, lambda some: self._called(some, log), self.batch_keys)
        rows = asked.drop(*tasks).join(log.known(), F.col(key).eqNullSafe(F.col("_key")), "left")
        return rows.select(asked.columns)

    def _called(self, prompts: DataFrame, log: ReplyLog) -> DataFrame:
        """Replies and calls of a frame of prompts; a null prompt is not asked."""
        answer, tasks = self.answer, log.tasks
        tasks_wanted, threads = self.split(prompts.sparkSession.sparkContext.defaultParallelism)

        def one(job: tuple[str, str | None, str | None]) -> tuple[str | None, dict | None]:
            if job[2] is None:
                return None, None
            reply, error, started = None, None, time.time()
            try:
                reply = answer(*job)
                error = "no reply" if reply is None else None
            except Exception as problem:
                error = f"{type(problem).__name__}: {problem}"[:500]
            return reply, {"task": job[0], "error": error, "started": started, "seconds": time.time() - started}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            with ThreadPoolExecutor(threads) as pool:
                for batch in batches:
                    jobs = [(t, n, p) for t in tasks for n, p in zip(batch["_key"], batch[t])]
                    found, size = list(pool.map(one, jobs)), len(batch)
                    said = {t: pd.Series([r for r, _ in found[i * size : (i + 1) * size]], dtype=object) for i, t in enumerate(tasks)}
                    calls = [[c for _, c in found[row::size] if c] for row in range(size)]
                    yield pd.DataFrame({"_key": batch["_key"].reset_index(drop=True), **said, "_calls": pd.Series(calls, dtype=object)})

        return prompts.repartition(tasks_wanted, "_key").mapInPandas(run, log.schema)

    def failed(self) -> DataFrame:
        """(key, task, error) of the questions that have no reply; only after an enrichment."""
        return functools.reduce(DataFrame.unionByName, [log.failed() for log in self.logs.values()])

    def figures(self) -> DataFrame:
        """Calls, replies, failures and speed by task; only after an enrichment."""
        return functools.reduce(DataFrame.unionByName, [log.figures() for log in self.logs.values()])


@dataclass
class LookupProvider:
    """Answers from a table of raw replies with a key column and one column per task.

    Of several replies for a key, the last by ``order`` counts; without such a column, the largest.
    """

    table: DataFrame
    key: str = "key"
    suffix: str = "_raw"
    order: str | None = None

    def replies(self, asked: DataFrame, key: str, tasks: tuple[str, ...]) -> DataFrame:
        said = F.struct(*[F.col(f"{t}{self.suffix}").alias(t) for t in tasks])
        one = F.max(said) if self.order is None else F.max_by(said, self.order)
        known = self.table.groupBy(F.col(self.key).alias(key)).agg(one.alias("_said")).select(key, "_said.*")
        return lookup_join(asked.drop(*tasks), known, key).select(asked.columns)


@dataclass
class RuleProvider:
    """Answers without a model: the first rule whose pattern the lower-case name matches gives the origin."""

    rules: list[tuple[str, str]]
    unknown: str = "Desconocido"

    def replies(self, asked: DataFrame, key: str, tasks: tuple[str, ...]) -> DataFrame:
        name = F.lower(F.col(key))
        origin = F.lit(self.unknown)
        for pattern, value in reversed(self.rules):
            origin = F.when(name.rlike(pattern), F.lit(value)).otherwise(origin)
        hard = name.rlike("[kwy]|tx|ll|rr")
        answers = {
            "origin": F.to_json(F.struct(origin.alias("origin"))),
            "description": F.concat(F.lit("**"), F.col(key), F.lit("** es un nombre de origen "), origin, F.lit(".")),
            "pronunciation": F.to_json(
                F.struct(
                    F.when(hard, "difícil").otherwise("muy fácil").alias("spanish"),
                    F.when(hard, "muy difícil").otherwise("fácil").alias("foreign"),
                    F.concat(F.lit("Suena como se escribe: "), F.col(key)).alias("explanation"),
                )
            ),
        }
        return asked.withColumns({t: answers[t] for t in tasks})


Provider = CallProvider | LookupProvider | RuleProvider


def parse_origin(raw: Column) -> Column:
    return json_default(raw, "origin", DEFAULT_ORIGIN)


def parse_description(raw: Column, name: Column, origin: Column) -> Column:
    """The reply or a stock sentence, cut to 500 characters and then cleaned."""
    text = default_if_falsy(raw, F.format_string(DEFAULT_DESCRIPTION, origin))
    return clean_text(truncate_ellipsis(text), name)


def parse_pronunciation(raw: Column, name: Column) -> Column:
    """Struct of both levels and the explanation. Only an explanation that came with the reply is cleaned."""
    parsed = json_all_or_nothing(raw, "explanation", FAILED_PRONUNCIATION, MISSING_PRONUNCIATION)
    explanation = parsed["explanation"]
    return F.struct(
        parsed["spanish"].alias("spanish"),
        parsed["foreign"].alias("foreign"),
        F.when(parsed["ok"], clean_text(explanation, name)).otherwise(explanation).alias("explanation"),
    )


def parse_replies(replies: DataFrame, key: str) -> DataFrame:
    """Key and the five new columns out of the raw replies and the origin that was used for the prompts."""
    said = parse_pronunciation(F.col("pronunciation"), F.col(key))
    described = parse_description(F.col("description"), F.col(key), F.col("Family_Origin"))
    return replies.select(key, "Family_Origin", described.alias("Name_Description"), said.alias("_said")).select(
        key,
        "Family_Origin",
        "Name_Description",
        F.col("_said.spanish").alias("Pronunciation_Spanish"),
        F.col("_said.foreign").alias("Pronunciation_Foreign"),
        F.col("_said.explanation").alias("Pronunciation_Explanation"),
    )


def enrich(df: DataFrame, key: str, provider: Provider) -> DataFrame:
    """Add origin, description and pronunciation of the name in ``key``; rows and other columns stay as they are.

    Each different name is asked about once. The origin comes first, as both other prompts name it. Columns of an earlier
    enrichment are replaced.
    """
    replies = provider.replies
    df = df.drop(*NEW_COLUMNS)
    keys = df.select(key).distinct()
    asked = keys.withColumn("origin", build_prompt("origin", F.col(key)))
    first = replies(asked, key, ("origin",))
    origins = first.select(key, parse_origin(F.col("origin")).alias("Family_Origin"))
    asked = origins.withColumns(
        {t: build_prompt(t, F.col(key), F.col("Family_Origin")) for t in ("description", "pronunciation")}
    )
    second = replies(asked, key, ("description", "pronunciation"))
    answers = parse_replies(second, key).withColumnRenamed(key, "_key")
    return lookup_join(df, answers, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def validate_domain(df: DataFrame, column: str, domain: list[str], out: str = "rows") -> DataFrame:
    """The values outside the domain with their number of rows."""
    allowed = df.sparkSession.createDataFrame([(v,) for v in domain], f"`{column}` string")
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(out))
    return counts.join(F.broadcast(allowed), column, "left_anti")
