"""Jaccard join of texts on word shingles, by a forest of MinHash prefix tries.

A text's signature is cut into trees of several values each; a tree sorts the texts by its values, and texts that share
the first values lie below one node. The join starts at the full depth, where only near copies meet, and shortens the shared
prefix value by value until both the estimated recall and that at the least similarity reach the target. Each round looks only at
nodes below which texts stand that no earlier round has brought together.

Texts with the same shingles are one class from the start, however many they are. Classes that meet at a node are candidates if their
whole signatures agree well enough; classes that candidates connect are compared exactly, block against block inside tasks that pass
on counts and one link for each class that joins a group, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .common import WORD, arrow_batches, ship, unused
from .components import components

ship(__name__)

SHINGLE, SIMILAR = 5, (4, 5)
TREES, DEPTH = 24, 6
TARGET = 0.9999
#: Agreement of whole signatures below which a pair is no candidate, six standard deviations below the least similarity; classes of a
#: node that are first compared with one of them only; and those that are looked at together: more are cut into blocks.
AGREES, STAR, NODE = 0.6, 256, 4_096
#: Classes in a block, classes of small groups that share a task, and keys that may be sent to every task.
BLOCK, TOGETHER, BROADCAST_ROWS = 512, 1_024, 1_000_000


LINKS = "id long, links long, expected array<double>, other long"


def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), lambda w: F.xxhash64(w))


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _key(keys: list[str]) -> Column:
    """A row's keys as one value to compare and sort by, nulls last."""
    return F.struct(*[F.col(k).isNull().alias(f"_null{i}") for i, k in enumerate(keys)], *keys)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Sorted different hashes of the runs of ``width`` words; a shorter text is one shingle; none without words."""
    words = np.asarray(words, np.int64).view(np.uint64)
    if not len(words):
        return words
    width = min(width, len(words))
    found = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        found = mixed(found * np.uint64(31) + words[k : len(words) - width + 1 + k] + np.uint64(k + 1))
    return np.unique(found)


def multipliers(number: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(1, 1 << 63, number, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, number, np.uint64)


def signature(found: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(found), 2048):
        least = np.minimum(least, (found[low : low + 2048, None] * factors + shifts).min(axis=0))
    # Sixteen bits tell values apart well enough; texts that are alike in a value stay so.
    return (least >> np.uint64(48)).astype(np.uint16).view(np.int16)


def _sign(batches: Iterator[pd.DataFrame], trees: int, depth: int) -> Iterator[pd.DataFrame]:
    factors, shifts = multipliers(trees * depth)
    with np.errstate(over="ignore"):
        for batch in batches:
            classes, numbers, signed = [], [], []
            for words in batch.pop("_words"):
                found = shingles(words)
                classes.append(class_of(found))
                numbers.append(len(found))
                signed.append(signature(found, factors, shifts).tolist() if len(found) else None)
            yield batch.assign(_class=pd.array(classes, "Int64"), _n=np.array(numbers, np.int64), _sign=pd.Series(signed, dtype=object, index=batch.index))


def class_of(found: np.ndarray) -> int | None:
    """The class of a text: a hash of its whole shingle set; none without shingles."""
    if not len(found):
        return None
    whole = np.bitwise_xor.reduce(mixed(found + np.uint64(5))) + np.uint64(len(found))
    return int(mixed(np.array([whole], np.uint64)).view(np.int64)[0])


def _shingle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    with np.errstate(over="ignore"):
        for batch in batches:
            found = [shingles(words) for words in batch["_words"]]
            right = [class_of(f) == i for f, i in zip(found, batch["id"])]
            sets = pd.Series([f.view(np.int64).tolist() for f in found], dtype=object)
            yield pd.DataFrame({"id": batch["id"].to_numpy(), "_set": sets})[np.array(right, bool)]


def detection(similarity: float, length: int, trees: int = TREES) -> float:
    """How likely two texts share a prefix of that length in at least one tree."""
    return 1 - (1 - similarity**length) ** trees


def _within(df: DataFrame, ids: DataFrame, on: list[str], how: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Semi or anti join; at most a million keys are sent to every task, more are joined by a shuffle."""
    known = stage(ids, "keys")
    return df.join(F.broadcast(known) if known.count() <= limit else known, on, how)


def _shingle_sets(docs: DataFrame, texts: DataFrame, ids: DataFrame, text: str) -> DataFrame:
    """(id, _set) of the classes in ``ids``; a class is read from the text of one of its rows."""
    rows = stage(texts.join(ids, "id", "left_semi").groupBy("id").agg(F.min("_hash").alias("_hash")), "reps")
    found = docs.select(_text_hash(text).alias("_hash"), F.col(text).alias("_text"))
    found = found.join(F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows, "_hash")
    found = found.groupBy("id").agg(F.first("_text").alias("_text")).select("id", word_hashes(F.col("_text")).alias("_words"))
    with arrow_batches(docs.sparkSession, 1_000):
        return stage(found.mapInPandas(_shingle_rows, "id long, _set array<long>"), "sets")


def compare(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which shingle sets are alike, and their similarities: of one list among each other, or of two lists across."""
    sets = left if right is None else left + right
    sizes = np.array([len(x) for x in sets])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    kept = np.bincount(place, minlength=len(values))[place] > 1
    place, owner = place[kept], owner[kept]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    a, b = (slice(None), slice(None)) if right is None else (slice(0, len(left)), slice(len(left), None))
    shared = np.zeros((len(sizes[a]), len(sizes[b])), np.float32)
    low = 0
    while low < len(place):
        high = np.searchsorted(place, place[low] + 4096)
        seen, column = np.unique(place[low:high], return_inverse=True)
        table = np.zeros((len(sets), len(seen)), np.float32)
        table[owner[low:high], column] = 1
        shared += table[a] @ table[b].T
        low = high
    union = sizes[a][:, None] + sizes[b][None, :] - shared
    alike = shared * SIMILAR[1] >= union * SIMILAR[0]
    if right is None:
        np.fill_diagonal(alike, False)
    return alike, shared / union


def spanning(number: int, pairs: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Of the pairs of some numbers, those that connect what was still apart."""
    head = list(range(number))

    def top(i: int) -> int:
        while head[i] != i:
            head[i] = head[head[i]]
            i = head[i]
        return i

    for i, j in pairs:
        p, q = top(i), top(j)
        if p != q:
            head[max(p, q)] = min(p, q)
            yield i, j


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the classes of each node, pairs of different groups whose signatures agree, as few as connect them.

    Pairs inside the largest group need no look, so that a node of near copies costs little once most of them are together.
    """
    for batch in batches:
        firsts, seconds = [], []
        for below in batch["_below"]:
            ids = [x["id"] for x in below]
            groups, signs = np.array([x["_near"] for x in below]), np.stack([x["_sign"] for x in below])
            known, place, sizes = np.unique(groups, return_inverse=True, return_counts=True)
            others = np.flatnonzero(place != sizes.argmax())
            pairs = ((i, j) for i in others for j in np.flatnonzero(((signs == signs[i]).mean(axis=1) >= AGREES) & (groups != groups[i])))
            for i, j in spanning(len(ids), pairs):
                firsts.append(ids[i]), seconds.append(ids[j])
        yield pd.DataFrame({"a": np.array(firsts, np.int64), "b": np.array(seconds, np.int64)})


def _like_the_lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        agree = [(np.asarray(x) == np.asarray(y)).mean() >= AGREES for x, y in zip(batch["_sign"], batch["_lead_sign"])]
        yield batch.loc[np.array(agree, bool), ["a", "b"]]


def _compare_cells(rows: pd.DataFrame, length: int, trees: int) -> pd.DataFrame:
    """Of each class the rows it is linked to and the links to expect at each length, and links that join the classes of a cell."""
    ids, links, weights, firsts, seconds = [], [], [], [], []
    for (_, b1, b2), cell in rows.groupby(["_near", "_b1", "_b2"], sort=False):
        sets = [np.asarray(x) for x in cell["_set"]]
        number, count = cell["id"].to_numpy(), cell["_m"].to_numpy().astype(np.int64)
        if b1 == b2:
            one = two = np.arange(len(cell))
            alike, similarity = compare(sets)
        else:
            block = cell["_block"].to_numpy()
            one, two = np.flatnonzero(block == b1), np.flatnonzero(block == b2)
            if not len(one) or not len(two):
                continue
            alike, similarity = compare([sets[i] for i in one], [sets[i] for i in two])
        x, y = np.nonzero(alike)
        if not len(x):
            continue
        # For each link, as many as it stands for at each length of prefix up to this one.
        stands = [1 / (1 - (1 - similarity[x, y].astype(float) ** k) ** trees) for k in range(1, length + 1)]
        sums = lambda at, n: np.column_stack([np.bincount(at, w * n, len(one) if at is x else len(two)) for w in stands])  # noqa: B023, E731
        ids.append(number[one]), links.append(alike @ count[two]), weights.extend(sums(x, count[two][y]).tolist())
        if b1 != b2:
            ids.append(number[two]), links.append(alike.T @ count[one]), weights.extend(sums(y, count[one][x]).tolist())
        for i, j in spanning(len(cell), ((one[row], other) for row in range(len(one)) for other in two[np.flatnonzero(alike[row])])):
            firsts.append(number[i]), seconds.append(number[j])
    own, joined = sum(map(len, ids)), len(firsts)
    return pd.DataFrame(
        {
            "id": np.concatenate([*ids, np.array(firsts, np.int64)]).astype(np.int64),
            "links": np.concatenate([*links, np.zeros(joined)]).astype(np.int64),
            "expected": pd.Series([*weights, *[None] * joined], dtype=object),
            "other": pd.array([*[None] * own, *seconds], "Int64"),
        }
    )


def _prefix(tree: Column | int, length: int, depth: int) -> Column:
    """A node of a tree: a hash of the first values of a signature's part."""
    tree = F.lit(tree) if isinstance(tree, int) else tree
    return F.xxhash64(tree, *[F.get("_sign", tree * depth + i) for i in range(length)])


def _forest(classes: DataFrame, trees: int, depth: int, least: int) -> DataFrame:
    """(id, p_least, …, p_depth) of each class and tree: its nodes by length, where another class shares the one of the least length.

    Nodes of greater lengths lie below those of lesser ones, so that one shuffle serves all lengths.
    """
    entries = classes.select("id", F.posexplode(F.array(*[_prefix(t, least, depth) for t in range(trees)])).alias("tree", "node"))
    shared = entries.groupBy("node").agg(F.count("*").alias("_rows")).where("_rows > 1").select("node")
    met = entries.join(shared, "node").select("id", "tree").join(classes.select("id", "_sign"), "id")
    return stage(met.select("id", *[_prefix(F.col("tree"), n, depth).alias(f"p{n}") for n in range(least, depth + 1)]), "forest")


def _nodes(forest: DataFrame, near: DataFrame | None, length: int) -> DataFrame:
    """(id, node, _near, _rows, _lead) of the nodes of a length below which classes of different groups stand."""
    rows = forest.select("id", F.col(f"p{length}").alias("node"))
    rows = rows.withColumn("_near", F.col("id")) if near is None else rows.join(near, "id", "left").withColumn("_near", F.coalesce("_near", "id"))
    nodes = rows.groupBy("node").agg(F.count("*").alias("_rows"), F.min("_near").alias("_low"), F.max("_near").alias("_high"), F.min("id").alias("_lead"))
    return stage(rows.join(nodes.where("_rows > 1 AND _low <> _high"), "node").select("id", "node", "_near", "_rows", "_lead"), "nodes")


def _marks() -> Column:
    """Seven bits of each value of a signature, which is what agreement is counted by."""
    return F.transform("_sign", lambda x: x.bitwiseAND(127).cast("tinyint"))


def _stars(forest: DataFrame, classes: DataFrame, near: DataFrame | None, length: int) -> DataFrame:
    """(a, b): the classes of large nodes whose signatures agree with that of the node's first class, which brings most near copies together."""
    pairs = _nodes(forest, near, length).where((F.col("_rows") > STAR) & (F.col("id") != F.col("_lead")))
    pairs = pairs.select(F.col("_lead").alias("a"), F.col("id").alias("b")).distinct()
    leads = classes.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi")
    leads = stage(leads.select(F.col("id").alias("a"), _marks().alias("_lead_sign")), "leads")
    signed = pairs.join(leads, "a").join(classes.select(F.col("id").alias("b"), _marks().alias("_sign")), "b")
    return stage(signed.select("a", "b", "_sign", "_lead_sign").mapInPandas(_like_the_lead, "a long, b long"), "stars")


def _meetings(forest: DataFrame, classes: DataFrame, near: DataFrame | None, length: int) -> DataFrame:
    """(a, b): candidates below the nodes of a length, as few as connect those that are still apart.

    A node of more than ``NODE`` classes is cut into blocks, of which all pairs are looked at.
    """
    rows = _nodes(forest, near, length).withColumn("_blocks", F.ceil(F.col("_rows") / NODE).cast("int"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("id", F.lit(4)), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumns({"_b1": F.least("_block", "_other"), "_b2": F.greatest("_block", "_other")})
    # At most two blocks in a list.
    lists = rows.join(classes.select("id", _marks().alias("_sign")), "id").groupBy("node", "_b1", "_b2").agg(F.collect_list(F.struct("id", "_near", "_sign")).alias("_below"))
    with arrow_batches(forest.sparkSession, 50):
        return stage(lists.select("_below").mapInPandas(_candidates, "a long, b long").distinct(), "meetings")


def _brought_together(near: DataFrame | None, meetings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, _near) of all classes that meet anything so far, and of those whose group has grown."""
    ids = meetings.select(F.col("a").alias("id")).union(meetings.select("b")).distinct()
    known = ids.withColumn("_near", F.col("id")) if near is None else near.unionByName(ids.join(near, "id", "left_anti").withColumn("_near", F.col("id")))
    known = stage(known, "known")
    side = lambda c: known.select(F.col("id").alias(c), F.col("_near").alias(f"_{c}"))
    between = meetings.join(side("a"), "a").join(side("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    grown = components(between).select(F.col("id").alias("_near"), F.col("comp").alias("_grown"))
    after = stage(known.join(grown, "_near", "left").select("id", F.coalesce("_grown", "_near").alias("_near"), F.col("_grown").isNotNull().alias("_new")), "near")
    return after.select("id", "_near"), after.where("_new").select("id", "_near")


def _compared(docs: DataFrame, texts: DataFrame, classes: DataFrame, near: DataFrame, text: str, trees: int, length: int) -> DataFrame:
    """(id, links, expected, other) rows of ``_compare_cells`` for groups of classes (id, _near), all compared with one another."""
    sizes = near.groupBy("_near").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    near = stage(near.join(sizes, "_near").join(classes.select("id", "_m"), "id"), "grown")
    sets = _shingle_sets(docs, texts, near.select("id"), text)
    blocked = near.withColumn("_block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("_blocks")).cast("int"))
    blocked = blocked.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    blocked = blocked.withColumns({"_b1": F.least("_block", "_other"), "_b2": F.greatest("_block", "_other")})
    # Small groups share tasks; a pair of blocks of a large one has a task of its own.
    shares = max(1, near.count() // TOGETHER)
    task = F.when(F.col("_blocks") == 1, F.pmod(F.xxhash64("_near"), F.lit(shares))).otherwise(F.xxhash64("_near", "_b1", "_b2"))
    cells = blocked.withColumn("_task", task).join(sets, "id").select("_task", "_near", "_b1", "_b2", "_block", "id", "_m", "_set")

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        return _compare_cells(rows, length, trees)

    return stage(cells.groupBy("_task").applyInPandas(compared, LINKS), "links")


def _link(docs: DataFrame, texts: DataFrame, classes: DataFrame, text: str, trees: int, depth: int, target: float) -> DataFrame:
    """(id, links, expected, other) rows of ``_compare_cells`` at the length of prefix that reaches the target."""
    likely = [length for length in range(1, depth + 1) if detection(SIMILAR[0] / SIMILAR[1], length, trees) >= target]
    least = max(likely, default=1)
    forest, near, found = _forest(classes, trees, depth, least), None, docs.sparkSession.createDataFrame([], LINKS)
    for length in range(depth, 0, -1):
        if length < least:
            least, forest = length, _forest(classes, trees, depth, length)
        grown = None
        for step in (_stars, _meetings):
            meetings = step(forest, classes, near, length)
            if not meetings.isEmpty():
                near, more = _brought_together(near, meetings)
                grown = more.select("id") if grown is None else grown.union(more.select("id"))
        if grown is not None:
            grown = stage(near.join(grown.distinct(), "id", "left_semi"), "changed")
            fresh = _compared(docs, texts, classes, grown, text, trees, length)
            # A group that has grown was compared anew, all others keep their links.
            found = stage(_within(found, grown.select("id"), ["id"], "left_anti").unionByName(fresh), "found")
        # Every class with links expects more of them, for those like its own that the forest misses at this length.
        row = found.agg(F.sum("links").alias("n"), F.sum(F.get("expected", F.lit(length - 1))).alias("all")).first()
        estimate = min(1.0, row["n"] / row["all"]) if row["all"] else 1.0
        if length <= max(likely, default=0) and estimate >= target:
            break
    return found


def near_copies(docs: DataFrame, keys: list[str], text: str = "text", trees: int = TREES, depth: int = DEPTH, target: float = TARGET) -> DataFrame:
    """Every row (by its keys) with ``group`` and ``n_links``.

    ``group`` is the smallest key (a struct) among the rows connected by links; ``n_links`` counts the other rows whose
    similarity is at least 0.8, rows with the same shingles included. A text of fewer than five words is one shingle; a null
    text or one without words has no shingles, is linked to nothing and is a group by itself (rows of the same keys and
    without words share a group). An empty table gives an empty one; a key called ``group`` or ``n_links`` is a ``ValueError``.
    """
    if clash := {k.lower() for k in keys}.intersection(("group", "n_links")):
        raise ValueError(f"no key can be called {', '.join(sorted(clash))}, as the join adds such a column")
    # Keys may be called like anything else that is added below.
    names, keys = keys, unused(docs, *[f"_key{i}" for i in range(len(keys))])
    docs = docs.withColumns({a: F.col(k) for a, k in zip(keys, names)})
    words = docs.select(*keys, _text_hash(text).alias("_hash"), word_hashes(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{fields}, _hash long, _class long, _n long, _sign array<smallint>"
    with arrow_batches(docs.sparkSession, 1_000):
        signed = stage(words.mapInPandas(lambda batches: _sign(batches, trees, depth), schema), "signed")
    texts = signed.where("_class is not null").withColumnRenamed("_class", "id")
    classes = stage(texts.groupBy("id").agg(F.count("*").alias("_m"), F.min(_key(keys)).alias("_first"), F.first("_sign").alias("_sign")), "classes")
    found = _link(docs, texts.select("id", "_hash"), classes, text, trees, depth, target)
    comps = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    inside = stage(classes.select("id", "_m", "_first").join(comps, "id", "left"), "inside")
    groups = inside.where("comp is not null").groupBy("comp").agg(F.min("_first").alias("group"))
    # Classes without a link, most of them, have no key to be dealt by and stay out of the join.
    alone = inside.where("comp is null").select("id", "_m", "_first", F.col("_first").alias("group"))
    known = inside.join(groups, "comp").select("id", "_m", "_first", "group").unionByName(alone).join(links, "id", "left")
    known = known.select(F.col("id").alias("_class"), F.coalesce("group", "_first").alias("group"), (F.col("_m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    known = stage(known, "known")
    wordless = signed.where("_class is null").select(*keys, _key(keys).alias("group"), F.lit(0).cast("bigint").alias("n_links"))
    out = signed.select(*keys, "_class").join(known, "_class").select(*keys, "group", "n_links").unionByName(wordless)
    flags = [F.col(f"group._null{i}").alias(f"_null{i}") for i in range(len(keys))]
    group = F.struct(*flags, *[F.col(f"group.{a}").alias(k) for a, k in zip(keys, names)])
    return out.select(*[F.col(a).alias(k) for a, k in zip(keys, names)], group.alias("group"), "n_links")


def keep_one(docs: DataFrame, order: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The table with one row of each group of near copies, the first by ``order`` (null first) and by hash of the row; rows equal in every column count as copies."""
    columns = docs.columns
    at, *hashes = keys = unused(docs, "_at", "_k1", "_k2")
    keyed = docs.withColumns({at: F.col(order), hashes[0]: F.xxhash64(*columns), hashes[1]: F.xxhash64(F.lit(1), *columns)})
    # Keys that are null would not meet in a join; the hashes alone tell rows apart.
    keyed = keyed.withColumn(at, F.coalesce(at, F.lit(-(1 << 62)).cast(docs.schema[order].dataType)))
    rows = near_copies(keyed, keys, text, **options).groupBy(*keys).agg(F.count("*").alias("_m"), F.first("group").alias("group"))
    rows = stage(rows, "members")
    gone = rows.where(F.col("group") != _key(keys)).select(*hashes)
    repeated = rows.where((F.col("group") == _key(keys)) & (F.col("_m") > 1)).select(*hashes)
    left = _within(keyed, gone.unionByName(repeated), hashes, "left_anti")
    once = _within(keyed, repeated, hashes, "left_semi").dropDuplicates(hashes)
    return left.unionByName(once).select(*columns)
