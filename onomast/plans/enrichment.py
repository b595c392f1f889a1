"""Sample, enrich, write."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.enrich import Provider, enrich
from ..operators.ranking import hashable
from ..operators.sampling import sample_rows
from ..sources.readers import FILE_ORDER
from ..sources.writers import write_records


def enrich_names(
    names: DataFrame,
    provider: Provider,
    mode: str = "sequential",
    n: int | None = None,
    seed: int | None = None,
    key: str = "Nombre",
    draw_by: str | list[str] | None = None,
) -> DataFrame:
    """Chosen rows with the five new columns.

    ``draw_by`` names the columns that tell rows apart and order them, by default the name and then all others. Names that
    come straight from a scan are taken in file order, if ``with_file_order`` has added it.
    """
    others = [c for c in hashable(names) if c not in (key, FILE_ORDER)]
    return enrich(sample_rows(names, mode, n, draw_by or [key, *others], seed).drop(FILE_ORDER), key, provider)


def write_enriched(enriched: DataFrame, path: str) -> bool:
    """Write as CSV; no output for an empty table."""
    return write_records(enriched, path, drop=())
