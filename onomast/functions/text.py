"""Text functions: each takes columns and returns a native column expression.

Regular expressions spell out their character classes, because Java's ``\\w`` counts combining marks
as letters and its ``\\s`` leaves out the four ASCII separators, and names data needs neither.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACE = r"\s\x{1c}-\x{1f}"
WORD = r"\p{L}\p{N}_"

# Fixed value: the letters that count as a vowel.
VOWELS = "aeiouáéíóúü"

# Place labels that have a customary form.
PLACE_OVERRIDES = {
    "RIOJA, LA": "LA RIOJA",
    "CORUÑA, A": "A CORUÑA",
    "RIOJA": "LA RIOJA",
}


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(c, f"(?U)^[{SPACE}]+|[{SPACE}]+$", "")


def char_count(c: Column) -> Column:
    """Number of code points; null counts 0."""
    return F.coalesce(F.length(c), F.lit(0))


def syllable_count(c: Column, vowels: str = VOWELS) -> Column:
    """Number of unbroken runs of vowels; null counts 0."""
    return F.coalesce(F.regexp_count(F.lower(c), F.lit(f"[{vowels}]+")), F.lit(0))


def is_compound(c: Column) -> Column:
    """True if the text has more than one word; null is false."""
    return F.coalesce(c.rlike(f"(?U)[^{SPACE}][{SPACE}]+[^{SPACE}]"), F.lit(False))


def build_key(name: Column, group: Column) -> Column:
    """``" maria luisa"``, ``"Female"`` → ``"MARIA_LUISA-f"``."""
    slug = F.replace(F.upper(strip(name)), F.lit(" "), F.lit("_"))
    return F.concat(slug, F.lit("-"), F.left(F.lower(group), F.lit(1)))


def safe_identifier(name: Column, group: Column) -> Column:
    """ASCII identifier of a name, ending in the group's initial, or in ``x`` where there is no group."""
    slug = F.btrim(F.regexp_replace(F.upper(name), "[^A-Za-z0-9]+", "_"), F.lit("_"))
    initial = F.left(F.lower(group), F.lit(1))
    return F.concat(slug, F.lit("_"), default_if_falsy(initial, F.lit("x")))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of each run of letters and lower-case the others (``O'Neil``, ``Jean-Luc``)."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def label_code(c: Column) -> Column:
    """``"13 Ciudad Real"`` → 13; null for an empty label, an error if the code is no number."""
    return F.when(F.length(c) > 0, F.split(c, " ")[0].cast("bigint"))


def label_text(c: Column, label_mode: str = "first_token") -> Column:
    """The label behind the code: its first word only, or (``label_mode="full"``) all of it."""
    if label_mode == "first_token":
        return F.when(F.length(c) > 0, F.get(F.split(c, " "), F.lit(1)))
    if label_mode == "full":
        return F.when(F.length(c) > 0, F.get(F.split(c, " ", 2), F.lit(1)))
    raise ValueError(f"label_mode must be 'first_token' or 'full', not {label_mode!r}")


def clean_label(c: Column, overrides: dict[str, str] | None = None) -> Column:
    """``"Palmas, Las"`` → ``"Las Palmas"``, ``"Balears,"`` → ``"Balears"``, then the overrides in title case."""
    overrides = PLACE_OVERRIDES if overrides is None else overrides
    bare = F.regexp_replace(strip(c), ",+$", "")
    turned = F.regexp_replace(bare, r"(?s)^((?:(?!, ).)*), ((?:(?!, ).)*)$", "$2 $1")
    if not overrides:
        return turned
    forms = F.create_map(*[F.lit(x) for label, form in overrides.items() for x in (label, form.title())])
    return F.coalesce(F.try_element_at(forms, F.upper(turned)), turned)


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, dict[str, str]]:
    """Compatibility forms without accents of the Latin letters, worked out from the Unicode data."""
    source, target, longer = [], [], {}
    for code in [*range(0x00A0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        form = "".join(x for x in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(x))
        if len(form) == 1 and form != letter:
            source.append(letter)
            target.append(form)
        elif len(form) > 1:
            longer[letter] = form
    return "".join(source), "".join(target), longer


def fold_accents(c: Column) -> Column:
    """Remove accents from Latin text, composed or decomposed."""
    source, target, longer = _folds()
    rare = F.regexp_replace(c, r"[\x{300}-\x{34E}\x{350}-\x{36F}]+", "")
    for letter, form in longer.items():
        rare = F.replace(rare, F.lit(letter), F.lit(form))
    # Only text with letters beyond the common ones pays for the rare ones, and only text beyond ASCII is translated.
    common = F.when(c.rlike(r"[^\x00-\xBB\xBF-\xFF]"), rare).otherwise(c)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(common, source, target)).otherwise(c)


def _fold_any_script(c: Column) -> Column:
    marks = {code: None for code in range(sys.maxunicode + 1) if unicodedata.combining(chr(code))}

    @F.pandas_udf(StringType())
    def fold(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.translate(marks)

    return fold(c)


def normalize_label(c: Column, any_script: bool = False) -> Column:
    """Comparison key of a label: no accents, upper case, words of ``A-Z0-9`` with single blanks; null if nothing is left.

    ``any_script`` also folds the compatibility forms of other scripts (full-width letters, ligatures),
    at the price of a trip to Python.
    """
    folded = _fold_any_script(c) if any_script else fold_accents(c)
    return F.nullif(F.btrim(F.regexp_replace(F.upper(folded), "[^A-Z0-9]+", " ")), F.lit(""))


def strip_markdown(c: Column) -> Column:
    """Remove the marks of ``**x**``, ``*x*``, ``__x__`` and ``_x_``, in this order."""
    # The four patterns.
    for pattern in (r"\*\*([^*]+)\*\*", r"\*([^*]+)\*", r"__([^_]+)__", r"_([^_]+)_"):
        c = F.regexp_replace(c, pattern, "$1")
    return c


def titlecase_terms(text: Column, terms: Column) -> Column:
    """Put each word of ``terms`` into title case wherever it stands as a whole word in ``text``, in any case."""

    def apply(done: Column, term: Column) -> Column:
        quoted = F.concat(F.lit(r"\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        before = F.when(term.rlike(f"^[{WORD}]"), F.lit(f"(?<![{WORD}])")).otherwise(F.lit(f"(?<=[{WORD}])"))
        after = F.when(term.rlike(f"[{WORD}]$"), F.lit(f"(?![{WORD}])")).otherwise(F.lit(f"(?=[{WORD}])"))
        titled = F.regexp_replace(title_case(term), r"([\\$])", r"\\$1")
        return F.regexp_replace(done, F.concat(F.lit("(?iu)"), before, quoted, after), titled)

    words = F.filter(F.split(terms, f"(?U)[{SPACE}]+"), lambda w: w != "")
    return F.when(terms.isNull(), text).otherwise(F.aggregate(words, text, apply))


def scrub_text(c: Column) -> Column:
    """One line of words, blanks and plain punctuation; double quotes become single ones."""
    c = F.replace(c, F.lit('"'), F.lit("'"))
    c = F.regexp_replace(c, f"(?U)[{SPACE}]+", " ")
    # Fixed value: the punctuation that stays.
    c = F.regexp_replace(c, rf"[^{WORD} .,;:!?()\-']", "")
    return F.btrim(c)


def clean_text(text: Column, terms: Column) -> Column:
    """Strip the markdown, put the terms into title case, scrub."""
    return scrub_text(titlecase_terms(strip_markdown(text), terms))


def truncate_ellipsis(c: Column, limit: int = 500) -> Column:
    """Cut a text of more than ``limit`` characters so that it ends in ``...`` at exactly ``limit``."""
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit - 3)), F.lit("..."))).otherwise(c)


def default_if_falsy(c: Column, default: Column) -> Column:
    """The default where the text is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), default)
