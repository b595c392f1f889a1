"""Main text of web pages, with the boilerplate of a host found by suffix arrays.

A page becomes blocks of text with marks of where they stood. The blocks of a page's only article are its text whatever repeats
in them. Pages with no article, or with several, are open: which of their blocks are text is decided among all pages of the host. The
blocks of these, articles included, make token streams, which are laid end to end and their suffixes sorted: long runs that
begin in several different pages are what the host repeats. Blocks that such runs cover go, and what is left, the unique runs, is the
page's text. Elements that are something else by tag, role or a whole class name go too; a name that only has such a word
as a part breaks ties. Hosts that are too large for one task are cut into parts; what pages of different parts share is found by hashes of the runs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path, stage
from .common import ship
from .near_copies import mixed

ship(__name__)

#: Least tokens of a repeated run, and the tokens of a host that one task takes; larger hosts are cut into parts.
RUN, PART_TOKENS = 6, 200_000

# Elements by what they mean for the text.
HIDDEN = frozenset("script style noscript template head title iframe svg canvas object select textarea button".split())
ASIDE = frozenset("nav footer aside form menu dialog".split())
CONTENT = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
MARKED = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|masthead|menu|modal|nav|navbar|navigation|"
    r"newsletter|notices?|pager|pagination|popup|promo|promotion|related|replies|reply|respond|share|sharing|sidebar|social|sponsor|sponsored|subscribe|toolbar|widget)(?:$|[-_ ])"
)
WHOLE = re.compile(MARKED.pattern.replace("(?:^|[-_ ])", "(?:^| )").replace("(?:$|[-_ ])", "(?:$| )"))
#: Strength of a mark: none, a part of a name, or what decides by itself.
UNMARKED, PERHAPS, SURELY = 0, 1, 2
#: Names that say what a layout has and not what the element is.
MODIFIER = re.compile(r"(?:^|(?<= ))(?:(?:has|have|with|without|no|not|hide|hidden|show)[-_]\S*|content[-_]sidebar\S*[-_]wrap(?:per)?)(?= |$)")
#: Names whose mark an article below keeps, as they hold lists of teasers or are a whole class, and those whose mark a main element keeps too.
TEASERS = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|newsletter|promo|promotion|related|share|sharing|social|sponsor|sponsored|subscribe|widget)(?:$|[-_ ])|"
    r"(?:^| )(?:banner|breadcrumbs?|consent|cookies?|footer|masthead|menu|modal|nav|navbar|navigation|notices?|pager|pagination|popup|sidebar|toolbar)(?:$| )"
)
COMMENTS = re.compile(r"(?:^|[-_ ])(?:comments?|disqus|replies|reply|respond)(?:$|[-_ ])")
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
SPACE = re.compile(r"\s+")


class _Blocks(HTMLParser):
    """Blocks of a page as (text, number of the outermost article from 1 or 0, strength of the mark as something else)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int, int]] = []  # tag, hidden, article, mark, 1 if an article keeps the mark, 2 if main does
        self.number: Counter[str] = Counter()  # open elements by tag: a page may leave very many open
        self.blocks: list[tuple[str, int, int]] = []
        self.articles = 0
        self.held: list[str] = []

    def state(self) -> tuple[bool, int, int, int]:
        return self.open[-1][1:] if self.open else (False, 0, UNMARKED, 0)

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.held)).strip()
        self.held.clear()
        hidden, content, marked, _ = self.state()
        if text and not hidden:
            self.blocks.append((text, content, marked))

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_P and self.innermost("p", ("table", "button", "td")):
            self.leave("p")
        elif tag == "li" and self.innermost("li", ("ul", "ol", "menu")):
            self.leave("li")
        hidden, content, marked, firm = self.state()
        found = {k: (v or "") for k, v in attrs}
        named = MODIFIER.sub("", SPACE.sub(" ", f"{found.get('class', '')} {found.get('id', '')}".lower()))
        fixed = 2 if tag in ASIDE or tag == "header" and not content or found.get("role", "").lower() in ROLES or COMMENTS.search(named) else 0
        own = SURELY if fixed or WHOLE.search(named) else PERHAPS if MARKED.search(named) else UNMARKED
        fixed = fixed or int(bool(TEASERS.search(named)))
        if tag in ("html", "body"):
            own, fixed = UNMARKED, 0
        if tag in CONTENT and firm < (2 if tag == "main" else 1):
            # A name of what is around an article says little of the article.
            marked, firm = UNMARKED, 0
        if tag in CONTENT and not marked and not content:
            self.articles += 1
            content = self.articles
        invisible = tag in HIDDEN or "hidden" in found or found.get("aria-hidden") == "true"
        inside = (hidden or invisible, content, max(marked, own), max(firm, fixed))
        if inside != self.state():
            self.flush()
        self.open.append((tag, *inside))
        self.number[tag] += 1

    def handle_startendtag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()

    def place(self, tag: str) -> int | None:
        """Where the innermost open element of a tag stands."""
        if not self.number[tag]:
            return None
        return next(at for at in range(len(self.open) - 1, -1, -1) if self.open[at][0] == tag)

    def innermost(self, tag: str, limits: tuple[str, ...]) -> bool:
        """Whether an element of that tag is open within the innermost of the limits."""
        return bool(self.number[tag]) and next(t for t, *_ in reversed(self.open) if t == tag or t in limits) == tag

    def close_from(self, at: int) -> None:
        self.number.subtract(t for t, *_ in self.open[at:])
        del self.open[at:]

    def leave(self, tag: str) -> None:
        at = self.place(tag)
        if at is not None:
            self.flush()
            self.close_from(at)

    def handle_endtag(self, tag):
        if tag in INLINE:
            at = self.place(tag)
            if at is not None and all(t in INLINE for t, *_ in self.open[at:]):
                if self.open[at][1:] != (self.open[at - 1][1:] if at else (False, 0, UNMARKED, 0)):
                    self.flush()
                self.close_from(at)
            return
        self.flush()
        self.leave(tag)

    def handle_data(self, data):
        if not self.state()[0]:
            self.held.append(data)


def page_blocks(html: str) -> list[tuple[str, int, int]]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without port and user; empty if there is none."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return found


def token_hashes(text: str) -> list[int]:
    """A number of 32 bits for each token; only runs of several equal tokens count, so that one collision does no harm."""
    return [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in text.split()]


def suffix_order(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes by their first ``depth`` tokens at least, by prefix doubling, and the ranks at each length."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    ranks, length = [rank], 1
    order = np.argsort(rank, kind="stable")
    while length < depth and n:
        second = np.full(n, -1, np.int64)
        second[: n - length] = rank[length:] if length < n else 0
        key = rank * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        ranks.append(rank)
        length *= 2
    return order, ranks


def repeated(tokens: np.ndarray, page: np.ndarray, run: int) -> np.ndarray:
    """For each token whether it lies in a run of ``run`` tokens or more that stands in at least two different pages.

    ``tokens`` has a number of its own between pages, so that no run crosses from one to the next. Suffixes that share a
    prefix are neighbours in the suffix array; a run is repeated if its neighbours with the same prefix come from
    different pages. A longer run is covered by the runs that start at each of its places.
    """
    n = len(tokens)
    covered = np.zeros(n + 1, np.int64)
    if n < run:
        return covered[:n] > 0
    order, ranks = suffix_order(tokens, run)
    # Common prefix of neighbours, as far as ``run``, from the ranks at the powers of two.
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
        step = 1 << k
        same &= (np.maximum(a, b) + step <= n)
        a[same] += step
        b[same] += step
        common[same] += step
    group = np.concatenate([[0], np.cumsum(common < run)])
    owner = page[order]
    size = group[-1] + 1
    first, last = np.full(size, np.iinfo(np.int64).max), np.full(size, -1, np.int64)
    np.minimum.at(first, group, owner)
    np.maximum.at(last, group, owner)
    starts = order[first[group] != last[group]]
    starts = starts[starts + run <= n]
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + run, -1)
    return np.cumsum(covered)[:n] > 0


def read_page(html: str) -> tuple[str | None, list[str], list[int], list[bool], list[int]]:
    """Text of a page with one article, or None; open blocks, their places in the stream and whether a name puts them in doubt; the stream.

    The stream has all blocks of an open page, in other pages those outside the article.
    """
    blocks = page_blocks(html)
    article = [text for text, inside, marked in blocks if inside and not marked]
    several = len({inside for _, inside, marked in blocks if inside and not marked}) > 1
    opened, at, doubt, stream = [], [], [], []
    for text, inside, marked in blocks:
        if article and not several and inside and not marked:
            continue
        if marked < SURELY and (several or not article):
            opened.append(text), at.append(len(stream)), doubt.append(marked == PERHAPS)
        stream += token_hashes(text)
    return None if opened else "\n".join(article), opened, at, doubt, stream


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for low in range(0, len(batch), 500):
            some = batch.iloc[low : low + 500]
            found = [read_page(h or "") for h in some.pop("_html")]
            column = lambda k: pd.Series([f[k] for f in found], dtype=object, index=some.index)  # noqa: B023, E731
            sizes = [len(f[4]) + len((f[0] or "").split()) for f in found]
            yield some.assign(_done=column(0), _opened=column(1), _at=column(2), _doubt=column(3), _stream=column(4), _size=sizes)


def whole_stream(stream: np.ndarray, done: str | None) -> np.ndarray:
    """Tokens of a page, those of its article last, behind a number that other pages do not have."""
    if not done:
        return np.asarray(stream, np.int64)
    return np.concatenate([np.asarray(stream, np.int64), [-(1 << 40) - zlib.crc32(done.encode("utf-8", "surrogatepass"))], token_hashes(done)]).astype(np.int64)


def run_hashes(stream: np.ndarray, run: int = RUN) -> np.ndarray:
    """A number of 64 bits for each run of ``run`` tokens, by the run's start."""
    number = max(0, len(stream) - run + 1)
    found = np.zeros(number, np.uint64)
    for k in range(run):
        found = mixed(found * np.uint64(31) + stream[k : k + number].astype(np.int64).view(np.uint64) + np.uint64(k + 1))
    return found.view(np.int64)


RUN_TYPES = {"_host": "object", "_cut": "int64", "_run": "int64", "_low": "int64", "_high": "int64", "_open": "bool"}


def _part_runs(pages: pd.DataFrame) -> pd.DataFrame:
    """The different runs of each part of a host: the smallest and largest page that has them, and whether an open page does."""
    found = [pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in RUN_TYPES.items()})]
    for (host, cut), some in pages.groupby(["_host", "_cut"], sort=False):
        hashes = [run_hashes(whole_stream(s, d)) for s, d in zip(some["_stream"], some["_done"])]
        sizes = [len(h) for h in hashes]
        runs = pd.DataFrame(
            {"_run": np.concatenate(hashes), "_page": np.repeat(some["_page"].to_numpy(), sizes), "_open": np.repeat(some["_done"].isna().to_numpy(), sizes)}
        )
        sums = runs.groupby("_run", sort=False).agg(_low=("_page", "min"), _high=("_page", "max"), _open=("_open", "max")).reset_index()
        found.append(sums.assign(_host=host, _cut=cut)[list(found[0].columns)])
    return pd.concat(found[1:] or found)


def _decide(pages: pd.DataFrame, elsewhere: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    """Texts of the open pages, among the streams of one part of a host; ``elsewhere`` has its runs that other parts repeat."""
    texts = []
    crossing = {k: some["_run"].to_numpy() for k, some in elsewhere.groupby(["_host", "_cut"], sort=False)}
    for part, some in pages.groupby(["_host", "_cut"], sort=False):
        opened = some["_done"].isna().to_numpy()
        if not opened.any():
            continue
        # Pages that are copies of one another are one page: what only they share is no boilerplate.
        streams = [whole_stream(s, d) for s, d in zip(some["_stream"], some["_done"])]
        first: dict[bytes, int] = {}
        owner = [first.setdefault(s.tobytes(), i) for i, s in enumerate(streams)]
        parts, numbers, start, at = [], [], {}, 0
        for i in sorted(first.values()):
            start[i] = at
            at += len(streams[i]) + 1
            parts += [streams[i], np.array([-1 - i], np.int64)]
            numbers.append(np.full(len(streams[i]) + 1, i, np.int64))
        covered = repeated(np.concatenate(parts), np.concatenate(numbers), RUN)
        for i in start if part in crossing else ():
            runs = start[i] + np.flatnonzero(np.isin(run_hashes(streams[i]), crossing[part]))
            for k in range(RUN):
                covered[runs + k] = True
        for i in np.flatnonzero(opened):
            row = some.iloc[i]
            kept, rest = [], []
            for text, place, doubt in zip(row["_opened"], row["_at"], row["_doubt"]):
                low = start[owner[i]] + place
                own = covered[low : low + len(text.split())]
                # The array cannot judge less than a run: there the name decides.
                if not doubt and not own.all() or doubt and not row["_alone"] and len(own) >= RUN and not own.any():
                    kept.append(text)
                elif doubt and len(own) >= RUN and not own.all():
                    rest.append(text)
            kept = kept or rest
            texts.append([*row[names], "\n".join(kept)])
    return pd.DataFrame(texts, columns=[*names, "text"])


def main_text(pages: DataFrame, carried: list[str], html: str = "html", url: str = "url", part_tokens: int = PART_TOKENS) -> DataFrame:
    """The ``carried`` columns, ``text`` and ``n_chars`` of every page.

    A null page is empty; pages without a host are a host of their own. Texts of single articles stay where they were parsed; the
    streams of hosts with an open page are dealt out by host. There, a block that other pages have too is no text, be it a teaser of their
    articles; so is one whose name is in doubt and that shares a run with another page, or is too short for a run, unless nothing else is left. Equal
    pages are one page. A host of more than ``part_tokens`` tokens and pages is cut into parts by the hash of the page, each with a
    suffix array of its own, so that no task holds a whole hot host. Runs that a part has in one page only are looked up by (host,
    hash of the run) among those of all parts, so that the cuts do not change the texts. An empty table gives an empty one; repeated rows are extracted each.
    """
    names = {f"_c{i}": c for i, c in enumerate(carried)}
    chosen = pages.select(*[F.col(c).alias(a) for a, c in names.items()], host_of(F.col(url)).alias("_host"), F.col(html).alias("_html"))
    fields = ", ".join(f"{a} {chosen.schema[a].dataType.simpleString()}" for a in names)
    parsed = chosen.mapInPandas(_parse, f"{fields}, _host string, _done string, _opened array<string>, _at array<long>, _doubt array<boolean>, _stream array<long>, _size long")
    path = scratch_path(pages.sparkSession, "blocks")
    parsed.write.option("compression", "zstd").parquet(path)
    parsed = pages.sparkSession.read.schema(parsed.schema).parquet(path)

    # Written, so that the planner sees how few they are and the streams are not dealt out by host first.
    page = F.xxhash64("_stream", F.coalesce("_done", F.lit("")))
    figures = F.sum(F.col("_size") + 1).alias("_n"), F.max(F.col("_done").isNull()).alias("_any"), (F.min(page) == F.max(page)).alias("_alone")
    cuts = F.greatest(F.ceil(F.col("_n") / part_tokens), F.lit(1)).cast("long")
    hosts = stage(parsed.groupBy("_host").agg(*figures).where("_any").select("_host", "_alone", cuts.alias("_cuts")), "hosts")
    streams = parsed.select(*[F.when(F.col("_done").isNull(), F.col(a)).alias(a) for a in names], "_host", "_done", "_opened", "_at", "_doubt", "_stream")
    dealt = streams.join(hosts, "_host").withColumn("_cut", F.pmod(F.xxhash64(page, *names), F.col("_cuts")))
    columns = list(names)

    # One column to deal by, so that the parts of a host do not follow its rows into one task.
    dealt = dealt.withColumn("_task", F.xxhash64("_host", "_cut"))
    cut = dealt.where("_cuts > 1").select("_host", "_cut", "_done", "_stream", page.alias("_page"), "_task")
    dealt = dealt.drop("_cuts")
    runs = stage(cut.groupBy("_task").applyInPandas(_part_runs, "_host string, _cut long, _run long, _low long, _high long, _open boolean"), "runs")
    shared = runs.groupBy("_host", "_run").agg(F.min("_low").alias("_least"), F.max("_high").alias("_most")).where("_least <> _most").select("_host", "_run")
    # A run that several pages of its part have is found there.
    elsewhere = runs.where("_open AND _low = _high").join(shared, ["_host", "_run"]).select("_host", "_cut", "_run", F.xxhash64("_host", "_cut").alias("_task"))

    def decide(rows: pd.DataFrame, elsewhere: pd.DataFrame) -> pd.DataFrame:
        return _decide(rows, elsewhere, columns)

    found = dealt.groupBy("_task").cogroup(elsewhere.groupBy("_task")).applyInPandas(decide, f"{fields}, text string")
    out = parsed.where("_done is not null").select(*names, F.col("_done").alias("text")).unionByName(found)
    return out.select(*[F.col(a).alias(c) for a, c in names.items()], "text", F.length("text").cast("bigint").alias("n_chars"))
