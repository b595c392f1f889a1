"""URL filters: rules for hosts and paths, and gradient-boosted trees on lexical features for the URLs that no rule knows. Native columns only.

The URLs that a rule judges are the labelled ones. A sample of them, of a stated size, is cut into bins by feature. Each level of a tree
takes one aggregate, the sums of gradients and curvatures by node, feature and bin, from which the best splits are read. Sums are
over whole numbers, so that the trees do not depend on the order of rows. A tree is applied as nested conditions on columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .quality_rules import let

#: Bound of the labelled URLs from which trees and suffix statistics are learnt.
SAMPLE_ROWS = 4_096
TREES, DEPTH, BINS, RATE, SHRINK, LEAST = 12, 3, 16, 0.4, 1.0, 8
#: Gradients are whole multiples of this part; labels that a suffix without any would weigh as.
UNIT, PRIOR_LABELS = 1 << 20, 10
ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Tree = float | tuple[str, int, "Tree", "Tree"]


@dataclass
class Model:
    """Log-odds of blocking without a tree, the trees, the part of blocked labels, and (kind, suffix, part) of the sample's suffixes."""

    base: float
    trees: list[Tree]
    part: float
    suffixes: DataFrame


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, in lower case; empty without it."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without a host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` that fits the host or a domain above it and the start of the path, or null; ties by the rule's text."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0]), reverse=True):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: list[tuple[str, str]]) -> Column:
    found = F.lit(None).cast("string")
    for name, verdict in rules:
        found = F.when(rule == name, F.lit(verdict)).otherwise(found)
    return found


def entropy_milli(text: Column) -> Column:
    """Entropy of a text's characters in thousandths of a bit; 0 for an empty one. Characters are sorted, equal ones stand together."""

    def ends(chars: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(chars) - 1), lambda i: F.coalesce(F.get(chars, i + 1) != F.get(chars, i), F.lit(True)))

    def weighed(last: Column) -> Column:
        counts = F.transform(last, lambda e, k: e - F.coalesce(F.get(last, k - 1), F.lit(-1)))
        return F.aggregate(counts, F.lit(0.0), lambda total, n: total + n * F.log2(n))

    chars = F.sort_array(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    size = F.length(text)
    bits = F.log2(size) - let(chars, lambda c: let(ends(c), weighed)) / size
    return F.when(size > 0, F.round(bits * 1000).cast("bigint")).otherwise(F.lit(0))


def _count(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("bigint")


def features_of(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Whole numbers that describe an address; those of an empty one for null."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    part = lambda text, pattern: F.when(F.length(text) > 0, F.floor(_count(text, pattern) * 1000 / F.length(text))).otherwise(F.lit(0)).cast("bigint")
    return {
        "length": F.length(url).cast("bigint"),
        "host_length": F.length(host).cast("bigint"),
        "path_length": F.length(path).cast("bigint"),
        "depth": _count(path, "/+[^/]"),
        "labels": _count(host, r"[^.]+"),
        "hyphens": _count(host, "-"),
        "digit_part": part(url, "[0-9]"),
        "host_digits": part(host, "[0-9]"),
        "mark_part": part(url, r"[^\p{L}\p{N}]"),
        "longest_number": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(url, F.lit("[0-9]+"), F.lit(0)), F.length)), F.lit(0)).cast("bigint"),
        "parameters": _count(query, "[^&;]+"),
        "entropy": entropy_milli(url),
        "host_entropy": entropy_milli(host),
    }


def suffixes_of(host: Column, path: Column) -> dict[str, Column]:
    """Suffixes of the host of one and two labels, the ending of the file, and the directory that the path starts with."""
    return {
        "top": F.regexp_extract(host, r"([^.]*)\.?$", 1),
        "domain": F.regexp_extract(host, r"([^.]*\.[^.]*)\.?$", 1),
        "ending": F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1),
        "directory": F.regexp_extract(path, r"^/+([^/]+)/", 1),
    }


def _described(urls: DataFrame, model_part: float, suffixes: DataFrame) -> DataFrame:
    """The frame (_url, _host, _path and others) with a column for each feature; suffix statistics are thousandths of blocked labels."""
    host, path = F.col("_host"), F.col("_path")
    out = urls.withColumns({f"_f_{name}": column for name, column in features_of(F.col("_url"), host, path).items()})
    for kind, suffix in suffixes_of(host, path).items():
        known = suffixes.where(F.col("kind") == kind).select(F.col("suffix").alias("_suffix"), F.col("part").alias("_part"))
        # At most as many rows as the sample has URLs, of two numbers each.
        out = out.withColumn("_suffix", F.xxhash64(suffix)).join(F.broadcast(known), "_suffix", "left").drop("_suffix")
        out = out.withColumn(f"_f_{kind}", F.coalesce("_part", F.lit(round(1000 * model_part)))).drop("_part")
    return out


def applied(tree: Tree, column) -> Column:
    """A tree as nested conditions; ``column`` gives the column of a feature."""
    if isinstance(tree, float):
        return F.lit(tree)
    name, limit, low, high = tree
    return F.when(column(name) <= limit, applied(low, column)).otherwise(applied(high, column))


def log_odds(base: float, trees: list[Tree], column) -> Column:
    total = F.lit(base)
    for tree in trees:
        total = total + applied(tree, column)
    return total


def best_split(sums: dict[tuple[str, int], tuple[int, int, int]], names: list[str]) -> tuple[float, str, int, list[int], list[int]] | None:
    """(gain, feature, last bin of the lower side, sums of both sides) that explains the gradients best, or None.

    ``sums`` has gradient, curvature and rows by (feature, bin). Ties go to the first feature and bin.
    """
    worth = lambda g, h: g * g / (h + SHRINK * UNIT)
    best = None
    for name in names:
        bins = sorted((b, v) for (f, b), v in sums.items() if f == name)
        whole = [sum(v[k] for _, v in bins) for k in range(3)]
        low = [0, 0, 0]
        for b, v in bins[:-1]:
            low = [x + y for x, y in zip(low, v)]
            if LEAST <= low[2] <= whole[2] - LEAST:
                high = [x - y for x, y in zip(whole, low)]
                gain = worth(*low[:2]) + worth(*high[:2]) - worth(*whole[:2])
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, name, b, low, high)
    return best


def _grow(rows: DataFrame, names: list[str]) -> Tree:
    """A tree over bins (columns ``_b_…``), level by level: an aggregate for each."""
    # Splits found so far, by node; node n has the children 2n and 2n + 1.
    splits: dict[int, tuple[str, int]] = {}
    leaves: dict[int, float] = {1: 0.0}

    def node_of(n: int) -> Column:
        if n not in splits:
            return F.lit(n)
        name, limit = splits[n]
        return F.when(F.col(f"_b_{name}") <= limit, node_of(2 * n)).otherwise(node_of(2 * n + 1))

    leaf = lambda sums: RATE * sums[0] / (sums[1] + SHRINK * UNIT)
    level = [1]
    for _ in range(DEPTH):
        cells = F.explode(F.array(*[F.struct(F.lit(name).alias("f"), F.col(f"_b_{name}").alias("b")) for name in names]))
        found = rows.select(node_of(1).alias("node"), "_g", "_h", cells.alias("c")).where(F.col("node").isin(level))
        sums = found.groupBy("node", "c.f", "c.b").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"), F.count("*").alias("n")).collect()
        by_node: dict[int, dict] = {}
        for r in sums:
            by_node.setdefault(r["node"], {})[r["f"], r["b"]] = (r["g"], r["h"], r["n"])
        level = []
        for node, cells in sorted(by_node.items()):
            if split := best_split(cells, names):
                splits[node] = split[1:3]
                leaves |= {2 * node: leaf(split[3]), 2 * node + 1: leaf(split[4])}
                level += [2 * node, 2 * node + 1]
        if not level:
            break

    def tree(n: int) -> Tree:
        return (*splits[n], tree(2 * n), tree(2 * n + 1)) if n in splits else float(leaves[n])

    return tree(1)


def _with_limits(tree: Tree, limits: dict[str, list[int]]) -> Tree:
    """The tree over features instead of bins."""
    if isinstance(tree, float):
        return tree
    name, b, low, high = tree
    return name, limits[name][b], _with_limits(low, limits), _with_limits(high, limits)


def sample_labelled(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` different (_url, _blocked), those with the smallest hashes: the same in each run, copies of a URL count once."""
    total = labelled.agg(F.approx_count_distinct("_url")).first()[0]
    # Twice the share wanted, as the number of different URLs is an estimate: few rows move.
    few = labelled if total <= 2 * rows else labelled.where(F.pmod(F.xxhash64("_url"), F.lit(1 << 32)) < int((1 << 32) * 2 * rows / total))
    return few.groupBy("_url", "_blocked").agg(F.xxhash64("_url").alias("_at")).orderBy("_at", "_url").limit(rows).drop("_at")


def learn(urls: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> Model | None:
    """Trees from the URLs that a rule judges; None where there is none."""
    chosen = urls.select(F.col(url).alias("_url")).where("_url is not null")
    rule = rule_of(host_of(F.col("_url")), path_of(F.col("_url")), rules)
    labelled = chosen.withColumn("_blocked", (verdict_of(rule, rules) == BLOCK).cast("int")).where("_blocked is not null")
    sample = stage(sample_labelled(labelled).withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))}), "urls")
    total, blocked = sample.agg(F.count("*"), F.sum("_blocked")).first()
    if not total:
        return None
    part = blocked / total
    base = log((blocked + 0.5) / (total - blocked + 0.5))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.xxhash64(c).alias("suffix")) for k, c in suffixes_of(F.col("_host"), F.col("_path")).items()])
    counts = sample.select(F.explode(kinds).alias("s"), "_blocked").groupBy("s.kind", "s.suffix").agg(F.sum("_blocked").alias("b"), F.count("*").alias("n"))
    smoothed = F.round((F.col("b") + PRIOR_LABELS * part) * 1000 / (F.col("n") + PRIOR_LABELS)).cast("int")
    suffixes = stage(counts.select("kind", "suffix", smoothed.alias("part")), "suffixes")
    if blocked in (0, total):
        return Model(base, [], part, suffixes)

    described = stage(_described(sample, part, suffixes), "features")
    names = sorted(c.removeprefix("_f_") for c in described.columns if c.startswith("_f_"))
    shares = [k / BINS for k in range(1, BINS)]
    quantiles = described.agg(*[F.percentile(f"_f_{name}", shares).alias(name) for name in names]).first()
    limits = {name: sorted({int(x // 1) for x in quantiles[name]}) for name in names}
    bins = {f"_b_{name}": sum((F.when(F.col(f"_f_{name}") > x, 1).otherwise(0) for x in limits[name]), F.lit(0)) for name in names}
    # The sample is at most SAMPLE_ROWS rows of small numbers: one task sums them faster than any exchange would deal them out.
    rows = stage(described.select("_blocked", *[c.alias(n) for n, c in bins.items()]), "bins").coalesce(1)

    trees: list[Tree] = []
    for _ in range(TREES):
        chance = 1 / (1 + F.exp(-log_odds(base, trees, lambda name: F.col(f"_b_{name}"))))
        graded = rows.withColumn("_p", chance)
        gradient = F.round((F.col("_blocked") - F.col("_p")) * UNIT).cast("bigint")
        trees.append(_grow(graded.withColumns({"_g": gradient, "_h": F.round(F.col("_p") * (1 - F.col("_p")) * UNIT).cast("bigint")}), names))
    # A bin beyond the last limit has no upper end and is never split off below.
    return Model(base, [_with_limits(t, limits) for t in trees], part, suffixes)


def judge_urls(table: DataFrame, rules: list[tuple[str, str]], model: Model | None, carried: list[str], url: str = "url") -> DataFrame:
    """The ``carried`` columns, host, path, rule, verdict and score of every row.

    The longest fitting rule decides; without one, the trees do: ``score`` is their chance of blocking, from 0.5 on blocked. Without a
    model, as when no URL is labelled, score is null and the verdict allow. A null URL, or one without ``://``, has an empty host and
    path and is judged by its features like any other. Repeated rows are judged each; an empty table gives an empty one.
    """
    names = {f"_c{i}": c for i, c in enumerate(carried)}
    rows = table.select(*[F.col(c).alias(a) for a, c in names.items()], F.col(url).alias("_url"))
    rows = rows.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    rows = rows.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))
    if model is None:
        rows = rows.withColumn("_score", F.lit(None).cast("double"))
    else:
        rows = _described(rows, model.part, model.suffixes)
        rows = rows.withColumn("_score", 1 / (1 + F.exp(-log_odds(model.base, model.trees, lambda name: F.col(f"_f_{name}")))))
    judged = F.when(F.col("_score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    verdict = F.coalesce(verdict_of(F.col("_rule"), rules), judged)
    return rows.select(
        *[F.col(a).alias(c) for a, c in names.items()],
        F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), verdict.alias("verdict"), F.col("_score").alias("score"),
    )

