"""Operators for training data against brute force, and on nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import base64
import hashlib
import itertools
import json
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from onomast.llm import chat, classifier, html_text, language, mixing, near_copies, nearest, packing, quality_rules, secret_scan
from onomast.llm.components import components
from onomast.llm.queries import ORACLES, QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, size string, comp string"
LONG = "palabra larga " * 30_000


def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and names that operators use themselves."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, "en", "a", 3, "x", "y", "z"), (1, text, "en", "a", 3, "x", "y", "z"), (2, text + " end", "en", "b", 3, "x", None, "z")]
    rows += [(3, "", "en", "b", 0, None, None, None), (4, None, None, None, None, None, None, None), (None, "ein Wort mit ö", "de", None, 1, "x", "y", "z")]
    rows += [(None, None, None, None, None, None, None, None), (5, " \n\t", "de", "c", 2, "x", "y", "z"), (6, LONG, "es", "c", 9, "x", "y", "z")]
    rows += [(7, "12345 67890", "en", "a", 3, "x", "y", "z"), (8, "😀".encode("utf-16", "surrogatepass").decode("utf-16"), "en", "a", 1, "x", "y", "z")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


def words(text):
    return WORD.findall(text or "")


def assert_own_names_do_not_matter(docs, function):
    """Columns named like those that the operators add keep their values and change no decision."""
    names = ["_k1", "_K2", "_at", "_lang", "_row", "_copies", "_i", "_m", "group"]
    out = function(docs.withColumns({n: F.lit(f"own {n}") for n in names}))
    assert out.columns == [*docs.columns, *names]
    assert all([r[n] for n in names] == [f"own {n}" for n in names] for r in out.collect())
    assert Counter(r["doc_id"] for r in out.collect()).keys() == Counter(r["doc_id"] for r in function(docs).collect()).keys()


# Mixing


def test_mix_meets_the_targets(spark, documents):
    rows = QUERIES["op1_mix_entropy"](spark, FOLDER).collect()
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    stopped = set()
    while True:
        level = (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in stopped)) / sum(w for s, w in weight.items() if s not in stopped)
        more = {s for s in sizes if s not in stopped and level * weight[s] > 2 * sizes[s]}
        if not more:
            break
        stopped |= more
    for s in sizes:
        assert target[s] == pytest.approx(2 * sizes[s] if s in stopped else level * weight[s])
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 30
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op1_mix_entropy"](spark, FOLDER).collect()))


def test_rates_solve_the_dual(spark, documents):
    """The multipliers against bisection, source by source; whole copies follow the tilted rates."""
    sizes = defaultdict(Counter)
    for r in QUERIES["op1_mix_entropy"](spark, FOLDER).join(documents.select("doc_id", "source"), "doc_id").collect():
        if r["size"]:
            sizes[r["source"]][r["size"]] += 1
    names = sorted(sizes)
    targets = [1.0, 1.6, 0.5, 1.99, 0.05]
    share = {s: targets[i % 5] * sum(n * k for n, k in sizes[s].items()) for i, s in enumerate(names)}
    cells = spark.createDataFrame([(i, n, k) for i, s in enumerate(names) for n, k in sizes[s].items()], "source_no long, size long, n long")
    sources = spark.createDataFrame([(i, share[s]) for i, s in enumerate(names)], "source_no long, target double")
    solved = {r["source_no"]: r for r in mixing._solve(cells, sources, 2.0).collect()}
    for i, s in enumerate(names):
        n, k = np.array(list(sizes[s])), np.array(list(sizes[s].values()))
        rates = lambda theta: np.minimum(2, np.exp(theta * n / solved[i]["mean"]))  # noqa: B023, E731
        low, high = -200.0, 200.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if (k * n * rates(middle)).sum() < share[s] else (low, middle)
        assert (k * n * rates(solved[i]["theta"])).sum() == pytest.approx(share[s], rel=1e-6)
        assert np.allclose(rates(solved[i]["theta"]), rates(low), rtol=1e-4)


def test_copies_follow_the_rates():
    rng = np.random.default_rng(2)
    for _ in range(20):
        # Sizes and numbers for which no cell reaches none or all of its copies.
        size = np.unique(rng.integers(100, 3_000, 60))[::-1]
        n, rate = rng.integers(20, 50, len(size)), np.exp(rng.uniform(-0.2, 0.2) * size / 1_000)
        target = float((n * size * rate).sum())
        cells = pd.DataFrame({"source_no": 0, "size": size, "n": n, "target": target, "rate": rate, "most": 2})
        found = mixing._round_copies(cells.sample(frac=1, random_state=1)).set_index("size")["_copies"]
        # What a cell misses is less than one document of it and of the one before.
        gaps = np.array([found[x] for x in size]) - n * rate
        before = np.concatenate([[0], size[:-1] / size[1:]]) / 2 + 0.5
        assert (np.abs(gaps) <= before + 1e-6).all()
        assert abs(float((found * found.index).sum()) - target) <= size[-1] / 2 + 1e-6


def test_mix_and_join_keys_of_any_name(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text, "a"), (2, text, "a"), (3, "other words", "b")], "k long, text string, source string")
    for name in ("_m", "before", "_base", "_draw", "_copies", "_hash", "_class", "_n", "_sign", "n", "theta"):
        named = docs.withColumnRenamed("k", name)
        assert sorted(r[name] for r in mixing.mix_sizes(named, [name]).collect()) == [1, 2, 3]
        found = {r[name]: (r["group"][name], r["n_links"]) for r in near_copies.near_copies(named, [name]).collect()}
        assert found == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    for function, name in ((mixing.mix_sizes, "Size"), (mixing.mix_sizes, "source"), (near_copies.near_copies, "group")):
        with pytest.raises(ValueError, match="no key can be called"):
            function(docs.withColumnRenamed("k", name) if name != "source" else docs, [name])


def test_mix_of_odd_rows(spark):
    docs = odd_documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    kept = Counter(r["doc_id"] for r in mixed.collect())
    assert kept[3] == 1 and kept[4] == 1 and kept[5] == 1 and max(kept.values()) <= 4
    assert len(mixing.mix_sizes(docs, ["doc_id"]).collect()) == docs.count()
    assert_own_names_do_not_matter(docs, mixing.mix)
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mix_sizes(docs.limit(0), ["doc_id"]).collect() == []


def test_mix_splits_one_hot_cell(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 600, "hot").otherwise("z").alias("source"))
    rows = mixing.mix_sizes(docs, ["doc_id"]).collect()
    target = {r["source"]: r["target"] for r in rows}
    for s in target:
        assert abs(sum(r["taken"] for r in rows if r["source"] == s) - target[s]) <= 3


# Packing


def check_pieces(pieces, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    by_doc, fill = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        fill[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(texts)
    for key, found in by_doc.items():
        ids = np.array(tokenizer.encode(texts[key] or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in sorted(found, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : at].tobytes())
        assert at == len(ids)
    lengths = []
    for number in sorted(fill):
        at = 0
        for offset, length in sorted(fill[number]):
            assert offset == at
            at += length
        lengths.append(at)
    assert sorted(fill) == list(range(len(fill))) and all(n == 1024 for n in lengths[:-1]) and lengths[-1] <= 1024


def test_pack_round_trip(spark, texts):
    check_pieces(QUERIES["op2_pack_concat"](spark, FOLDER).collect(), texts)


def test_pack_odd_texts(spark):
    texts = dict(enumerate(["", None, " ", "a  b\n\n c ", "don't  _x 3½²", "<|endoftext|> x", "日本語 。", LONG, "a\x1c b", "　x", "é́ ​ y", "tab\t\tx "]))
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, start string").repartition(3)
    pieces = packing.pack(docs, tokenizer_path(), ["doc_id"])
    check_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).collect(), texts)
    assert packing.pack(docs.limit(0), tokenizer_path(), ["doc_id"]).collect() == []


def test_pack_queries_read_added_tokens(spark, tmp_path):
    """The queries' ids are those of the tokenizer's file with no setting changed."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y\n\n<|endoftext|>  ", "a <|endoftext| > b", "plain words a b", None, "a\x1c <|endoftext|>b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for found in (QUERIES["op2_pack_concat"](spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, str(tmp_path))):
        rows = {r["doc_id"]: r for r in found.collect()}
        for key, text in enumerate(texts):
            ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
            assert (rows[key]["doc_tokens"], rows[key]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


def test_encoder_agrees_on_all_characters_and_tokens():
    """Every character in several surroundings, every token of the vocabulary, and long runs, against plain tokenizers."""
    from tokenizers import Tokenizer

    encode, tokenizer = packing.Encoder(tokenizer_path(), "<u2", plain=False), Tokenizer.from_file(tokenizer_path())
    assert encode.fast
    characters = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}b 1{c} {c}!{c}{c} " for c in characters[low : low + 40]) for low in range(0, len(characters), 40)]
    alphabet = packing.byte_alphabet()
    tokens = [bytes(alphabet[c] for c in t).decode("utf-8", "ignore") for t in tokenizer.get_vocab() if all(c in alphabet for c in t)]
    texts += [t for token in tokens for t in (token, f"x {token}")]
    texts += [c * 70_000 for c in ("a", " ", "\n", "é", "!", "7", " \n", "ab ", "'s")] + ["", "<|endoftext|>", "a<|endoftext|> \n"]
    plain = [np.array(e.ids, "<u2").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert encode(texts) == plain


def test_encoder_leaves_other_files_to_tokenizers(tmp_path):
    file = json.loads(open(tokenizer_path(), encoding="utf-8").read())
    assert packing.merge_ranks(file) and packing.merge_ranks(file | {"normalizer": {"type": "NFC"}}) is None
    assert packing.merge_ranks(file | {"model": file["model"] | {"merges": file["model"]["merges"][::-1]}}) is None
    (tmp_path / "nfc.json").write_text(json.dumps(file | {"normalizer": {"type": "NFC"}}))
    other, usual = packing.Encoder(str(tmp_path / "nfc.json"), "<u2"), packing.Encoder(tokenizer_path(), "<u2")
    assert not other.fast and other(["e\u0301", ""]) == usual(["\u00e9", ""])


# Nearest neighbours


def test_nearest_recall_and_scores(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas()
    matrix, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    found = defaultdict(list)
    for r in QUERIES["op3_nearest_adaptive"](spark, FOLDER).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[i]
        scores[i] = -np.inf
        exact = ids[np.lexsort((ids, -scores))[:20]]
        rows = found[ids[i]]
        hits += len(set(exact) & {v for v, _ in rows})
        assert len(rows) == 20 and rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        assert np.allclose([s for _, s in rows], [scores[np.flatnonzero(ids == v)[0]] for v, _ in rows], rtol=0, atol=1e-12)
    assert hits >= 0.9 * 20 * len(found)


def test_nearest_on_odd_vectors(spark):
    same = [(i, [1.0, 0.0, 0.0]) for i in range(100, 0, -1)]
    odd = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 0.0]), (203, [float("nan"), 1.0, 0.0]), (204, [float("inf"), 1.0, 0.0]), (205, [1.0]), (None, [1.0, 1.0, 1.0]), (100, [1.0, 0.0, 0.0])]
    table = spark.createDataFrame(same + odd, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    rows = nearest.nearest(table, F.col("vec_id") % 20 == 0).collect()
    for q in (20, 40, 100):
        assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] == [i for i in range(1, 22) if i != q][:20]
    assert {r["query_id"] for r in rows} == {20, 40, 60, 80, 100}
    few = nearest.nearest(table.where("vec_id < 4"), F.col("vec_id") == 2).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in few] == [(1, 1, 1.0), (2, 3, 1.0)]
    assert nearest.nearest(table.limit(0), F.lit(True)).collect() == [] and nearest.nearest(table.where("vec_id = 200"), F.lit(True)).collect() == []


def vectors_of(spark, matrix):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<double>")


def recall_of(table, matrix, asked, k=20):
    found = defaultdict(list)
    for r in nearest.nearest(table, asked, k).collect():
        found[r["query_id"]].append(r["vec_id"])
    shares = []
    for q, ids in found.items():
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        assert len(ids) == min(k, len(matrix) - 1) == len(set(ids))
        shares.append(len(set(np.lexsort((np.arange(len(matrix)), -scores))[:k].tolist()) & set(ids)) / len(ids))
    return len(found), float(np.mean(shares))


def test_nearest_among_vectors_of_several_lengths(spark):
    """Each length is searched by itself; none is left out."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=(3, 8, 20)[i % 3]).tolist()) for i in range(300)] + [(301, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in nearest.nearest(table, F.col("vec_id") % 10 == 0, 5).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    assert set(found) == set(range(0, 300, 10))
    right = 0
    for q, ids in found.items():
        others = [(-np.dot(rows[q][1], v), i) for i, v in rows if i != q and len(v) == len(rows[q][1])]
        right += len({i for _, i in sorted(others)[:5]} & set(ids))
        assert len(ids) == 5 and all(i % 3 == q % 3 for i in ids)
    assert right >= 0.9 * 5 * len(found)


def test_nearest_in_narrow_cones(spark):
    """Clustered vectors of different lengths: most probed lists have no candidate that passes the bound."""
    rng = np.random.default_rng(5)
    axes = rng.normal(size=(8, 32))
    axes /= np.linalg.norm(axes, axis=1)[:, None]
    matrix = (axes[rng.integers(0, 8, 1200)] + 0.02 * rng.normal(size=(1200, 32))) * rng.lognormal(0, 0.7, 1200)[:, None]
    table = vectors_of(spark, matrix)
    asked, share = recall_of(table, matrix, F.col("vec_id") % 20 == 0)
    assert asked == 60 and share >= 0.9
    asked, share = recall_of(table, matrix, F.col("vec_id") == 7)
    assert asked == 1 and share >= 0.9
    assert nearest.nearest(table, F.lit(False)).collect() == []


def test_nearest_with_lists_without_a_survivor(spark):
    """Two far groups on opposite sides: the other group's lists keep nothing for any query."""
    rng = np.random.default_rng(6)
    side = np.where(np.arange(800) % 2 == 0, 1.0, -1.0)
    matrix = np.column_stack([side * 100, rng.normal(size=(800, 15))])
    asked, share = recall_of(vectors_of(spark, matrix), matrix, F.col("vec_id") % 40 == 0)
    assert asked == 20 and share >= 0.9


# Secrets

ASSIGNED = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGNED.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def test_secret_query_against_brute_force(spark, texts):
    for r in QUERIES["op4_secrets_structural"](spark, FOLDER).collect():
        spans = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]


def der(tag, body):
    length = len(body)
    head = bytes([length]) if length < 128 else bytes([0x82]) + length.to_bytes(2, "big")
    return bytes([tag]) + head + body


def der_key():
    number = der(2, b"\x01" + b"\x7f" * 64)
    return der(0x30, der(2, b"\0") + number * 8)


def test_structural_confirmation():
    key = der_key()
    broken = bytearray(key)
    broken[3] ^= 1
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"pub") + field(b"private part")
    part = lambda x: base64.urlsafe_b64encode(x if isinstance(x, bytes) else json.dumps(x).encode()).decode().rstrip("=")
    signed = ".".join([part({"alg": "HS256"}), part({"sub": 1}), part(b"x" * 32)])
    unsigned = ".".join([part({"typ": "JWT"}), part({"sub": 1}), part(b"x" * 32)])
    code = base64.b64encode(key).decode()
    wrapped = "\n".join(code[i : i + 64] for i in range(0, len(code), 64))
    kinds = lambda t: [s[0] for s in secret_scan.find_spans(t) if s[0] not in ("assign", "access", "hex")]
    assert kinds(f"é {code} z") == ["der"] and kinds(f"-----BEGIN X-----\n{wrapped}\n-----END X-----") == ["der"]
    assert kinds(key.hex()) == ["der"] and kinds(base64.b64encode(bytes(broken)).decode()) == []
    assert kinds(base64.b64encode(ssh).decode()) == ["openssh"] and kinds(base64.b64encode(ssh + b"x").decode()) == []
    assert kinds(signed) == ["jwt"] and kinds(unsigned) == [] and kinds("a" * 100_000) == []
    (kind, start, end), *_ = [s for s in secret_scan.find_spans(f"é {code} z") if s[0] == "der"]
    assert (start, end) == (2, 2 + len(code))


def test_keys_in_base64_wherever_they_stand():
    short = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, b"\x7f" * 32)))
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"pub" * 9) + field(b"private part" * 30)
    for data, kind in ((short, "der"), (der_key(), "der"), (ssh, "openssh")):
        code = base64.b64encode(data).decode()
        bare = code.rstrip("=")
        lines = [code[i : i + 64] for i in range(0, len(code), 64)]
        found = lambda t: [t[a:b] for k, a, b in secret_scan.find_spans(t) if k == kind]  # noqa: B023, E731
        assert found(f"PRIVATE_KEY={code}") == found(f"/x?key={code}&y=1") == [code]
        for end in ("\n", "\r\n", "\\n", "\\r\\n", "\\\\n", "\n    ", "  \n\t", " "):
            pem = end.join(["-----BEGIN PRIVATE KEY-----", *lines, "-----END PRIVATE KEY-----", ""])
            assert found(f'{{"private_key": "{pem}"}}') == [end.join(lines)]
        assert found(f"{bare}\nword\n") == found(f"{bare}\\nword") == found(f"{'a' * 40}\n{bare}\nword\nword") == [bare]
        assert found(f"{bare}\n{bare}\n") == [bare, bare] and found(f"{bare}AA") == found(f"x{bare}") == found(bare[:-4]) == []
    # Many starts in one run of lines.
    assert secret_scan.find_spans("\n".join(["MIIC" + "x" * 60] * 20_000)) == []


def test_keys_of_any_width_and_encoded_twice():
    short = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, b"\x7f" * 32)))
    found = lambda t, kind="der": [t[a:b] for k, a, b in secret_scan.find_spans(t) if k == kind]
    for data in (short, der_key()):
        code = base64.b64encode(data).decode()
        for width in (16, 28, 63, 64, 76):
            lines = "\n".join(code[i : i + width] for i in range(0, len(code), width))
            assert found(f"-----BEGIN KEY-----\n{lines}\n-----END KEY-----") == [lines]
        pem = f"-----BEGIN PRIVATE KEY-----\n{code}\n-----END PRIVATE KEY-----\n"
        twice = base64.b64encode(pem.encode()).decode()
        assert found(f"tls.key: {twice}\nnext: word") == [twice] and found(f'key="{twice}" x') == [twice]
        wrapped = "\n  ".join(twice[i : i + 60] for i in range(0, len(twice), 60))
        assert found(f"data: |\n  {wrapped}\n") == [wrapped]
        assert found(base64.b64encode(pem.replace(code[:8], "AAAAAAAA").encode()).decode()) == []
        pairs = ":".join(f"{b:02x}" for b in data)
        rows = ":\n    ".join(":".join(f"{b:02X}" for b in data[i : i + 15]) for i in range(0, len(data), 15))
        assert found(f"bytes {pairs} end") == [pairs] and found(rows) == [rows] and found(pairs[:-3]) == []
    assert found("at 12:30:00 " * 50) == [] and found("MANAGEMENT AND MACHINES " * 2_000) == []


def test_tokens_by_their_decoded_header():
    part = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
    body, sign = part(b'{"sub":1}'), part(b"x" * 32)
    found = lambda t: [t[a:b] for k, a, b in secret_scan.find_spans(t) if k == "jwt"]
    for header in (b'{"alg":"HS256"}', b'{\n "alg": "HS256"\n}', b'{\t"alg":"RS256"}', b' \n{"typ":"JWT","alg":"ES256"}'):
        token = f"{part(header)}.{body}.{sign}"
        for text in (token, f"a.{token}", f"a.b.{token} c", f"x={token}&y", f"{token}.", f"eyfoo12345.{token}", f"({token})"):
            assert found(text) == [token], text
    assert found(f"{part(b'[1]')}.{body}.{sign}") == found("www.example.com/a.b.c " * 100) == found("a." * 50_000) == []
    assert found(f"{part(b'{}')}.{body}.{sign}") == found(f"{part(json.dumps({'alg': 'HS256'}).encode())}.{body}.short") == []


def test_redaction_keeps_all_rows(spark):
    docs = odd_documents(spark).unionByName(odd_documents(spark).limit(1).withColumn("text", F.lit('x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y')))
    clean = secret_scan.redact_secrets(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert Counter(r["text"] for r in clean.collect()) - Counter(r["text"] for r in docs.collect()) == Counter(['x [SECRET]" y'])
    assert secret_scan.scan_secrets(docs.limit(0), ["doc_id"]).collect() == []


# Language


def test_language_on_held_out_rows(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = QUERIES["op5_language_mixture"](spark, FOLDER).collect()
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_mixture(grams, model):
    """The chosen set and shares of one document, by loops over its trigrams: EM over all languages, then over each nested set."""
    probs, n = np.exp(model.astype(float)), len(grams)

    def fit(shares, steps):
        for _ in range(steps):
            sums = np.zeros(len(shares))
            for g in grams:
                joint = shares * probs[g]
                sums += joint / joint.sum()
            shares = sums / n
        return shares

    langs = model.shape[1]
    full = fit(np.full(langs, 1 / langs), 12)
    order, best = np.argsort(-full, kind="stable"), None
    for k in range(langs):
        shares = np.zeros(langs)
        shares[order[: k + 1]] = full[order[: k + 1]] + 1e-6
        shares = fit(shares / shares.sum(), 6 if k else 0)
        value = sum(np.log(probs[g] @ shares) for g in grams) / 3 - k * np.log(max(n / 3, 2))
        if best is None or value > best[0]:
            best = (value, int(shares.argmax()), float(shares.max()))
        elif k >= 3:
            break
    return best[1:]


def test_mixtures_against_plain_expectation_maximisation(documents):
    langs, model = language.learn(documents)
    letters = language.letter_table()
    rows = [r["text"] for r in documents.where("length(text) > 30").orderBy("doc_id").limit(60).collect()]
    cut = [t[:300] for t in rows] + [a[:200] + " " + b[:120] for a, b in zip(rows, rows[7:])] + ["a", "ß é", " ".join(t[:90] for t in rows[:12])]
    grams = [language.trigrams(t, letters) for t in cut]
    grams = [g for g in grams if len(g)]
    lang, share = language.mixtures(grams, model)
    plain = [plain_mixture(g, model) for g in grams]
    assert np.mean([a == b for a, (b, _) in zip(lang, plain)]) == 1
    assert np.allclose(share, [s for _, s in plain], atol=2e-3)


def test_language_of_odd_and_mixed_texts(spark, documents):
    langs, model = language.learn(documents)
    found = odd_documents(spark).select("doc_id", "text", language.language_column(F.col("text"), langs, model).alias("l")).collect()
    for r in found:
        assert (r["l"]["lang"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    some = {r["lang"]: r["text"] for r in documents.where("length(text) > 800").orderBy("doc_id").collect()}
    both = some["de"][:800] + "\n" + some["fr"][:400]
    (row,) = language.predict([both], langs, model, language.letter_table()).to_dict("records")
    assert row["lang"] == "de" and 0.5 < row["score"] < 0.85
    assert language.learn(documents.limit(0))[0] == []


def test_language_of_texts_in_four_languages(spark, documents):
    langs, model = language.learn(documents)
    some = {r["lang"]: r["text"] for r in documents.where("length(text) > 800 AND lang IS NOT NULL").orderBy("doc_id").collect()}
    assert len(langs) == len(some) == 4
    four, one = "\n".join(t[:400] for t in some.values()), some["de"][:800]
    found = language.predict([one, four, one + some["fr"][:400], four], langs, model, language.letter_table())
    assert all(0.2 < found["score"][i] < 0.31 for i in (1, 3))
    # Documents that are worked on together do not change one another.
    alone = [language.predict([t], langs, model, language.letter_table()).iloc[0].tolist() for t in (one, four, one + some["fr"][:400])]
    assert found["lang"].tolist()[:3] == [a[0] for a in alone] and np.allclose(found["score"][:3], [a[1] for a in alone], atol=1e-5)


# Near copies


def brute_links(texts):
    sets = {}
    for key, text in texts.items():
        w = words(text)
        sets[key] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    keys = sorted(sets)
    return [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if sets[a] & sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]


def check_groups(rows, texts):
    head, degree = {k: k for k in texts}, Counter()

    def top(k):
        while head[k] != k:
            k = head[k]
        return k

    for a, b in brute_links(texts):
        degree[a] += 1
        degree[b] += 1
        a, b = top(a), top(b)
        head[max(a, b)] = min(a, b)
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == {k: (top(k), degree[k]) for k in texts}


def test_near_copies_against_brute_force(spark, texts):
    check_groups(QUERIES["op6_near_copies_forest"](spark, FOLDER).collect(), texts)


def test_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 8)
    monkeypatch.setattr(near_copies, "TOGETHER", 4)
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join([*base[:20], f"x{i % 40}", *base[21:]]) for i in range(60)} | {100 + i: " ".join(f"v{i}_{j}" for j in range(30)) for i in range(5)}
    texts |= {200: "a b", 201: "a  b", 202: "", 203: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = near_copies.near_copies(docs, ["doc_id"])
    check_groups(found.select("doc_id", F.col("group.doc_id").alias("class_id"), "n_links").collect(), texts)


def test_near_copies_shorten_prefixes_of_a_deeper_forest(spark, monkeypatch):
    """A depth that meets the target takes one round; deeper ones take more rounds and find the same."""
    rounds, meet = [], near_copies._meetings
    monkeypatch.setattr(near_copies, "_meetings", lambda *a: rounds.append(1) or meet(*a))
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join([*base[:20], f"x{i}", *base[21:]]) for i in range(12)} | {100 + i: " ".join(f"v{i}_{j}" for j in range(30)) for i in range(5)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for depth, expected in ((5, 1), (near_copies.DEPTH, 2), (8, 4)):
        rounds.clear()
        found = near_copies.near_copies(docs, ["doc_id"], depth=depth)
        check_groups(found.select("doc_id", F.col("group.doc_id").alias("class_id"), "n_links").collect(), texts)
        assert len(rounds) == expected


def test_texts_that_share_a_passage_are_no_group(spark, monkeypatch):
    """Jaccard about 0.3 with all others: texts meet at nodes, but their signatures keep them apart and little is compared."""
    compared, plain = [], near_copies._compared
    monkeypatch.setattr(near_copies, "_compared", lambda *a: compared.append(a[3].count()) or plain(*a))
    passage = " ".join(f"p{j}" for j in range(32))
    texts = {i: f"{passage} " + " ".join(f"w{i}_{j}" for j in range(34)) for i in range(1_500)}
    texts |= {2_000: texts[0] + " end", 2_001: texts[1] + " end"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_copies.near_copies(docs, ["doc_id"]).select("doc_id", F.col("group.doc_id").alias("g"), "n_links").collect()
    assert {(r["doc_id"], r["g"], r["n_links"]) for r in rows if r["n_links"]} == {(0, 0, 1), (2_000, 0, 1), (1, 1, 1), (2_001, 1, 1)}
    assert len(rows) == len(texts) and sum(compared) <= 12


def test_rounds_add_to_groups_of_earlier_rounds(spark, monkeypatch):
    """A chain of texts, each like its neighbours only, found in any order of rounds, in small blocks and nodes."""
    monkeypatch.setattr(near_copies, "BLOCK", 4)
    monkeypatch.setattr(near_copies, "NODE", 3)
    monkeypatch.setattr(near_copies, "STAR", 2)
    rng = np.random.default_rng(4)
    texts = {i: " ".join(f"w{j}" for j in range(4 * i, 4 * i + 60)) for i in range(30)}
    texts |= {100 + i: " ".join([f"v{j}" if rng.random() > 0.02 else f"x{i}" for j in range(80)]) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_copies.near_copies(docs, ["doc_id"])
    check_groups(rows.select("doc_id", F.col("group.doc_id").alias("class_id"), "n_links").collect(), texts)


def test_keep_one(spark):
    docs = odd_documents(spark)
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    # Row 2 shares 8 of 9 shingles with row 1; texts without words stay, fully equal rows are one.
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "3", "4", "None", "None", "5", "6", "7", "8"])
    assert_own_names_do_not_matter(docs, near_copies.keep_one)
    assert near_copies.keep_one(docs.limit(0)).collect() == []


def test_components_follow_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (7, 7)]
    found = {r["id"]: r["comp"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({found[i] for i in range(41)}) == 1 and found[100] == found[101] != found[102] == found[103] and len(found) == 45


# Pages


def test_pages_are_their_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    from html import unescape

    for r in QUERIES["op7_pages_suffix"](spark, FOLDER).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:h1|p|br)>", "\0", body)).split("\0")
        expected = "\n".join(x for x in (" ".join(unescape(b).split()) for b in blocks) if x)
        assert r["text"] == expected and r["n_chars"] == len(expected)


@pytest.mark.parametrize("part_tokens", [200_000, 80])
def test_pages_without_an_article(spark, part_tokens):
    menu = "<div>Home News Sport Weather Travel Contact us today</div>"
    rows = [(i, f"http://u@A.b:80/{i}", f"<body>{menu}<p>Page {i} has &amp; a text n{i} of its&nbsp;own</p><p class='ad'>buy</p><div id=comments><p>nice</p></div>") for i in range(6)]
    rows += [(9, None, None), (10, "", ""), (11, "x", "<p>a<p>b <span class='ad'>no</span> c<br>d<li>e<table><tr><td>f<td>g</table><!-- x --><script>'</p>'</script>")]
    rows += [(12, "http://c.d/", "<main><p>Home News Sport Weather Travel Contact us today</p><aside>x</aside></main><p>out"), (0, *rows[0][1:])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_text", F.lit(1))
    found = Counter((r["page_id"], r["text"]) for r in html_text.main_text(frame, ["page_id", "url"], part_tokens=part_tokens).collect())
    expected = Counter((i, f"Page {i} has & a text n{i} of its own") for i in [0, *range(6)])
    assert found == expected + Counter([(9, ""), (10, ""), (11, "a\nb\nc\nd\ne\nf\ng"), (12, "Home News Sport Weather Travel Contact us today")])
    assert html_text.main_text(frame.limit(0), ["page_id"]).collect() == []


@pytest.mark.parametrize("part_tokens", [200_000, 80])
def test_runs_of_few_pages_of_a_cut_host(spark, part_tokens):
    """Each notice stands on two of eighty pages, which seldom share a part; copies of one page are one page, in whatever parts."""
    rows = [(i, "http://a.b/", f"<p>page {i} has words n{i} of its own here</p><div>notice {i // 2} of section {i // 2} closed today</div>") for i in range(80)]
    rows += [(100 + i, "http://a.b/", "<p>these are the very same words on all copies</p>") for i in range(20)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.main_text(frame, ["page_id"], part_tokens=part_tokens).collect()}
    own = {i: f"page {i} has words n{i} of its own here" for i in range(80)}
    assert found == own | {100 + i: "these are the very same words on all copies" for i in range(20)}


@pytest.mark.parametrize("part_tokens", [200_000, 60])
def test_the_array_decides_open_pages(spark, part_tokens, monkeypatch):
    """Pages without article elements or telling names, teasers beside a story, and names that only have such a word as a part."""
    story = lambda i: " ".join(f"story{i}word{k}" for k in range(20))
    notice = "We keep small files on your machine to count visits"
    rows = [(i, "http://a.b/", f"<div><div>{notice}</div><div>{story(i)}</div><p>short {i}</p><div>Terms and more about all of us here</div></div>") for i in range(12)]
    # Two articles are teasers of other pages; the story stands beside them.
    tease = "".join(f"<article>{' '.join(story(i).split()[:8])}</article>" for i in (3, 4))
    rows.append((50, "http://a.b/", f"{tease}<div><p>{story(50)}</p></div><div>{notice}</div>"))
    # One article of two is the page's own.
    rows.append((51, "http://a.b/", f"<article>{story(51)}</article><article>{' '.join(story(60).split()[:9])}</article>"))
    # The text of a single article is evidence, and stays whole.
    rows.append((60, "http://a.b/", f"<div>{notice}</div><article><p>{story(60)}</p><p>{notice}</p></article>"))
    rows.append((61, "http://a.b/", f"<p class='related-work'>{story(61)}</p><p>{story(62)}</p>"))
    rows.append((62, "http://a.b/", f"<p class='related-work'>{notice} {story(63)}</p><p class='ad-slot'>buy now</p><p>{story(64)}</p>"))
    rows.append((63, "http://alone/", f"<p class='related-work'>{story(65)}</p>"))
    rows.append((64, "http://alone.too/", f"<p class='cookie-notice'>{notice}</p><p>{story(66)}</p>"))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    read = lambda: {r["page_id"]: r["text"] for r in html_text.main_text(frame, ["page_id"], part_tokens=part_tokens).collect()}
    found = read()
    assert found == {i: f"{story(i)}\nshort {i}" for i in range(12)} | {
        50: story(50), 51: story(51), 60: f"{story(60)}\n{notice}", 61: f"{story(61)}\n{story(62)}", 62: story(64), 63: story(65), 64: story(66)
    }
    # With the array off, what the host repeats stays.
    monkeypatch.setattr(html_text, "repeated", lambda tokens, page, run: np.zeros(len(tokens), bool))
    monkeypatch.setattr(html_text, "run_hashes", lambda stream: np.empty(0, np.int64))
    off = read()
    assert {i for i in off if off[i] != found[i]} == {*range(12), 50, 51, 62} and notice in off[50]


def test_articles_in_layouts_named_after_a_sidebar():
    text = lambda html: html_text.read_page(html)[0]
    opened = lambda html: html_text.read_page(html)[1]
    for name in ("layout has-sidebar", "with-sidebar", "no-sidebar", "content-sidebar-wrap", "sidebar-layout", "page nav-open", "has_sidebar"):
        for tag in ("article", "main"):
            page = f"<div class='{name}'><{tag}><p>the text</p><div class='share'>share</div></{tag}><div class='sidebar'>more</div><aside>x</aside></div>"
            assert text(page) == text(page.replace("class='" + name, "id='" + name)) == "the text"
    for name in ("layout has-sidebar", "with-sidebar", "no-sidebar", "content-sidebar-wrap"):
        assert opened(f"<div class='{name}'><p>the text</p><div class='sidebar'>more</div></div>") == ["the text"]
        assert text(f"<article class='post {name}'>the text</article>") == "the text"
    for start, end in (("<div class='comments'>", "</div>"), ("<section id='post-replies'>", "</section>"), ("<aside>", "</aside>"), ("<div role='complementary'>", "</div>")):
        page = f"<div class='has-sidebar'><article>the text</article>{start}<div><article>no text</article></div>{end}</div>"
        assert text(page) == "the text" and text(f"{start}<article>no text</article>{end}") == ""
        assert text(f"<article>the text{start}<article>no text</article>{end}</article>") == "the text"
    for name in ("related", "related-posts", "sidebar", "footer-widget"):
        teaser = f"<div class='{name}'><article>teaser</article></div>"
        assert text(f"<article>the text{teaser}</article>") == text(f"<div class='sidebar-layout'><article>the text</article>{teaser}</div>") == "the text"
    assert text("<div class='nav'><main><div class='sidebar-layout'><article>the text</article></div></main></div>") == "the text"


def test_pages_that_leave_elements_open():
    deep = "<div>" * 60_000 + "a" + "<b>" * 60_000 + "b" + "</i>" * 60_000 + "<li>c" * 60_000
    assert [t for t, *_ in html_text.page_blocks(deep)] == ["a" + "b", *["c"] * 60_000]


def test_repeated_runs_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        page = np.sort(rng.integers(0, 4, 60))
        tokens = rng.integers(0, 3, 60)
        breaks = np.flatnonzero(np.diff(page, append=9))
        tokens[breaks] = -1 - np.arange(len(breaks))
        owners = defaultdict(set)
        for i in range(60 - 5):
            owners[tuple(tokens[i : i + 6])].add(page[i])
        covered = np.zeros(60, bool)
        for i in range(60 - 5):
            covered[i : i + 6] |= len(owners[tuple(tokens[i : i + 6])]) > 1
        assert (html_text.repeated(tokens, page, 6) == covered).all()


# Quality rules


def test_quality_rules_agree_with_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    cursor = db.execute(ORACLES["op8_quality_cascade"])
    names = [c[0] for c in cursor.description]
    found = QUERIES["op8_quality_cascade"](spark, FOLDER).select(*names)
    assert Counter(map(tuple, found.collect())) == Counter(cursor.fetchall())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_counts_of_odd_texts(spark):
    counted = quality_rules.base_counts(odd_documents(spark), ["doc_id"])
    rows = {r["doc_id"]: r for r in counted.collect() if r["doc_id"] is not None}
    assert tuple(rows[4])[2:] == (0, 0, 0, 0, 0) and tuple(rows[3])[2:] == (0, 0, 0, 0, 0)
    assert rows[6]["n_words"] == rows[6]["n_repeat_words"] == 60_000 and rows[6]["word_chars"] == 12 * 30_000
    judged = quality_rules.cascade(counted, quality_rules.default_rules(), counted)
    assert judged.where("doc_id = 7").first()["failed_rule"] == "letters"
    empty = counted.limit(0)
    assert quality_rules.cascade(empty, quality_rules.default_rules(), empty).collect() == []


def test_cascade_order_does_not_change_the_verdict(spark):
    table = spark.range(100)
    rules = {"a": F.col("id") % 2 == 0, "b": F.col("id") % 3 == 0, "c": F.lit(None).cast("boolean")}
    for names in (["a", "b", "c"], ["c", "b", "a"]):
        found = quality_rules.cascade(table, {n: rules[n] for n in names}, table)
        assert [r["id"] for r in found.where("failed_rule is null").orderBy("id").collect()] == [i for i in range(100) if i % 2 and i % 3]


# Quality network


def test_network_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op9_quality_network"](spark, folder).collect()
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    ones, zeros = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([[a > b for b in zeros] for a in ones]) >= 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_network_gradients():
    rng = np.random.default_rng(0)
    model = classifier.train([[bytes(512)], [b"x" * 512]], [0, 1], steps=1)
    model = {k: v.astype(np.float64) for k, v in model.items()}
    data, owner = rng.integers(0, 256, (5, 512)).astype(np.uint8), np.array([0, 0, 1, 2, 2])
    y, weight = np.array([1, 0, 1.0]), np.ones(3)

    def loss():
        total = 0.0
        for d in range(3):
            chunk = [np.maximum(classifier_values(c, model).max(axis=0) + model["bias"], 0) for c in data[owner == d]]
            pooled = np.concatenate([np.mean(chunk, axis=0), np.max(chunk, axis=0)])
            hidden = np.maximum(pooled @ model["hidden"] + model["hidden_bias"], 0)
            p = 1 / (1 + np.exp(-(hidden @ model["out"] + model["out_bias"])[0]))
            total -= np.log(p if y[d] else 1 - p)
        return total / 3

    def classifier_values(chunk, m):
        places = m["embed"][chunk].reshape(-1, classifier.STEP * classifier.DEPTH)
        out = places @ m["first"]
        out[:-1] += places[1:] @ m["second"]
        return out

    grads = classifier._forward_back(model, data, owner, y, weight)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        step = 1e-6
        model[name][at] += step
        up = loss()
        model[name][at] -= 2 * step
        down = loss()
        model[name][at] += step
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=1e-3), name


def test_network_score_against_a_plain_forward_pass():
    """The score of whole texts by loops over bytes, places, chunks and filters."""
    rng = np.random.default_rng(4)
    model = {k: rng.normal(size=v.shape) for k, v in classifier.train([], []).items()}

    def plain(text):
        data = list(text.encode())
        data += [0] * (-len(data) % 256)
        data += [0] * max(0, 512 - len(data))
        places = [[model["embed"][b][d] for b in data[at : at + 4] for d in range(4)] for at in range(0, len(data), 4)]
        places.append([0.0] * 16)
        chunks = []
        for low in range(0, len(data) - 256, 256):
            found = []
            for f in range(32):
                seen = [sum(x * w for x, w in zip(places[p], model["first"][:, f])) + sum(x * w for x, w in zip(places[p + 1], model["second"][:, f])) for p in range(low // 4, low // 4 + 128)]
                found.append(max(0.0, max(seen) + model["bias"][f]))
            chunks.append(found)
        pooled = [sum(c[f] for c in chunks) / len(chunks) for f in range(32)] + [max(c[f] for c in chunks) for f in range(32)]
        hidden = [max(0.0, sum(p * w for p, w in zip(pooled, model["hidden"][:, h])) + model["hidden_bias"][h]) for h in range(16)]
        return 1 / (1 + np.exp(-np.clip(sum(h * w for h, w in zip(hidden, model["out"][:, 0])) + model["out_bias"][0], -30, 30)))

    model["out"] /= 50
    for text in ("", "short", "ünï" * 150, "word and " * 57, "x" * 512, "x" * 513, "a b\n" * 400):
        assert classifier.probability(text, model) == pytest.approx(plain(text), rel=1e-6)


def test_network_reads_long_texts_in_pieces():
    rng = np.random.default_rng(0)
    model = {k: rng.normal(size=v.shape).astype(np.float32) for k, v in classifier.train([], []).items()}
    for size in (0, 700, classifier.PIECE - 1, classifier.PIECE, classifier.PIECE + 1, 2 * classifier.PIECE + 777):
        data = classifier.padded(bytes(rng.integers(32, 126, size).astype(np.uint8)).decode())
        whole = classifier.filtered(data, model).reshape(-1, classifier.HALF // classifier.STEP, classifier.FILTERS).max(axis=1)
        assert np.allclose(classifier.half_maxima(data, model), whole, rtol=1e-4, atol=1e-4)


def test_network_scores_odd_texts(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (6, 0), (None, 1), (7, None), (99, 1)], "doc_id long, quality int")
    model = classifier.learn(docs, labels)
    scores = [r[0] for r in docs.select(classifier.score_column(F.col("text"), model)).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    flat = classifier.learn(docs, labels.limit(0))
    assert classifier.probability("", flat) == pytest.approx(0.5)


# Chat


def test_chat_roles(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op10_chat_transcripts"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/conversations.parquet").count()
    assert sum(r["role"] == r["role_found"] for r in rows) >= 0.9 * len(rows)
    assert all(r["rendered"].startswith(f"<|{r['role_found']}|>\n") and r["rendered"].endswith("<|end|>\n") for r in rows)


def test_chat_roles_of_conversations_not_learnt_from(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    apart = F.crc32(F.col("conv_id").cast("string")) % 5 == 0
    model = chat.learn(rows.where(~apart).withColumnRenamed("conv_id", "conv"))
    found = chat.recover_turns(rows.where(apart), model, carried=["role"]).collect()
    right = sum(r["role"] == r["role_found"] for r in found)
    assert right >= 0.9 * len(found) > 100, (right, len(found))


def test_chat_roles_of_the_table(spark):
    """Roles that are not among the three are learnt and found, by their markers and by what they look like."""
    rows = []
    for conv in range(60):
        rows += [(conv, 0, "user", "what is the weather in the north today?"), (conv, 1, "tool", "- t=4\n- w=9\n- h=80\n- p=1012"), (conv, 2, "assistant", "It is cold. " * 12), (conv, 3, None, "?"), (conv, 4, " ", "?")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    model = chat.learn(frame.withColumnRenamed("conv_id", "conv"))
    assert model.roles == ("system", "user", "assistant", "tool")
    found = chat.recover_turns(frame.where("turn < 3"), model, carried=["role"]).collect()
    assert all(r["role"] == r["role_found"] for r in found) and len(found) == 180
    one = spark.createDataFrame([(1, 0, "User: go on\nTool: done\nall of it\nAI: fine")], "conv_id long, turn long, text string")
    (row,) = chat.recover_turns(one, model).collect()
    assert row["rendered"] == "<|user|>\ngo on<|end|>\n<|tool|>\ndone\nall of it<|end|>\n<|assistant|>\nfine<|end|>\n" and row["n_turns"] == 3


def test_long_transcript_in_one_text(spark, speakers):
    text = "\n".join(f"{'User' if i % 2 else 'Assistant'}: line {i}\nmore" for i in range(20_000))
    (row,) = chat.recover_turns(spark.createDataFrame([(1, 0, text)], "conv_id long, turn long, text string"), speakers).collect()
    assert row["n_turns"] == 20_000 and row["rendered"].count("<|end|>\n") == 20_000


@pytest.fixture(scope="module")
def speakers(spark):
    return chat.learn(spark.read.parquet(f"{FOLDER}/conversations.parquet").withColumnRenamed("conv_id", "conv"))


def test_markers_in_one_text(spark, speakers):
    text = "System: be kind\nUser: what is it?\nand why?\n\nAssistant: it is this.\n**Human:** thanks"
    frame = spark.createDataFrame([(1, 0, text), (None, 0, "hm"), (2, None, None), (2, 0, ""), (2, 0, "")], "conv_id long, turn long, text string")
    found = {(r["conv_id"], r["turn"], r["rendered"], r["n_turns"]) for r in chat.recover_turns(frame, speakers).collect()}
    expected = "<|system|>\nbe kind<|end|>\n<|user|>\nwhat is it?\nand why?\n<|end|>\n<|assistant|>\nit is this.<|end|>\n<|user|>\nthanks<|end|>\n"
    assert (1, 0, expected, 4) in found and len([r for r in found if r[0] is None]) == 1
    assert chat.recover_turns(frame, speakers).count() == 5 and chat.recover_turns(frame.limit(0), speakers).collect() == []


def test_ranges_do_not_change_the_path(spark, speakers):
    rng = np.random.default_rng(5)
    rows = [(1, i, "x " * int(rng.integers(1, 300)) + ("?" if rng.random() < 0.5 else ".")) for i in range(80)] + [(2, 0, "hello"), (0, 0, "hi?")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(4)
    results = []
    for partitions in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        results.append(sorted(map(tuple, chat.recover_turns(frame, speakers).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert results[0] == results[1] and len(results[0]) == 82


def test_ranges_part_copies_of_a_row(spark, speakers, monkeypatch):
    """Copies of one row, in a conversation and without one, are dealt out to several ranges and decoded as in one."""
    rows = [(1, 3, "User: hello\nand more?")] * 900 + [(None, None, "hm.")] * 900 + [(2, i, f"line {i}") for i in range(200)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(4)
    staged, write = {}, chat.stage
    monkeypatch.setattr(chat, "stage", lambda df, label: staged.setdefault(label, []).append(out := write(df, label)) or out)
    results = []
    for partitions in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        results.append(Counter(map(tuple, chat.recover_turns(frame, speakers).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in staged["turns"][1].groupBy("_part").count().collect()) <= 500
    assert results[0] == results[1] and sum(results[0].values()) == 2_000


def test_number_of_ranges_follows_the_characters(spark, speakers, monkeypatch):
    frame = spark.createDataFrame([(i % 3, i, "x" * 936) for i in range(200)], "conv_id long, turn long, text string").repartition(4)
    staged, write = {}, chat.stage
    monkeypatch.setattr(chat, "stage", lambda df, label: staged.setdefault(label, []).append(out := write(df, label)) or out)
    whole = sorted(map(tuple, chat.recover_turns(frame, speakers).collect()))
    monkeypatch.setattr(chat, "RANGE_CHARS", 10_000)
    assert sorted(map(tuple, chat.recover_turns(frame, speakers).collect())) == whole
    sizes = [r["count"] for r in staged["turns"][1].groupBy("_part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 30


def test_paths_against_all_paths(speakers):
    """Viterbi's path against the best of all sequences of states, from given scores to a given state."""
    rng = np.random.default_rng(3)
    texts = ["User: why?\nit is late.\n- one", "hm\nAssistant: no.\nUser: oh?", "one line", "```\ncode\nSystem: x"]
    for text in texts:
        for opens in (False, True):
            matrices = chat.row_matrices(speakers, text, opens)
            entry = rng.normal(size=speakers.states)
            for last in (None, 0, 3):
                best = (-np.inf, None)
                for path in itertools.product(range(speakers.states), repeat=len(matrices)):
                    if last is None or path[-1] == last:
                        score = (entry + matrices[0][:, path[0]]).max() + sum(m[a, b] for m, a, b in zip(matrices[1:], path, path[1:]))
                        best = max(best, (score, path), key=lambda x: x[0])
                if np.isfinite(best[0]):
                    found = chat.decode(matrices, entry, last)
                    score = (entry + matrices[0][:, found[0]]).max() + sum(m[a, b] for m, a, b in zip(matrices[1:], found, found[1:]))
                    assert len(found) == len(matrices) and score == pytest.approx(best[0])
            whole = chat.chained(matrices)
            exact = np.array([[max((matrices[0][i, p[0]] + sum(m[a, b] for m, a, b in zip(matrices[1:], p, p[1:])) for p in itertools.product(range(speakers.states), repeat=len(matrices)) if p[-1] == j)) for j in range(speakers.states)] for i in (0, 5)])
            assert np.allclose(whole[[0, 5]], exact)


# Pipeline


def test_pipeline_against_brute_force(spark, texts, documents):
    import corpus_pipeline

    docs, kept = documents, {}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, FOLDER)
        if name != "packing":
            assert out.columns == documents.columns
        docs = corpus_pipeline.stage(out, name)
        kept[name] = docs.collect()
    lettered = {k for k, t in texts.items() if any(c.isalpha() for c in t)}
    assert {r["doc_id"] for r in kept["language"]} == lettered
    head = {k: k for k in lettered}

    def top(k):
        while head[k] != k:
            k = head[k]
        return k

    for a, b in brute_links({k: texts[k] for k in lettered}):
        a, b = top(a), top(b)
        head[max(a, b)] = min(a, b)
    assert sorted(r["doc_id"] for r in kept["near_copies"]) == sorted(k for k in lettered if top(k) == k)
    clean = {r["doc_id"]: r for r in kept["secrets"]}
    assert set(clean) == {r["doc_id"] for r in kept["near_copies"]}
    for k, r in clean.items():
        assert base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        assert r["text"] == texts[k] or base_spans(texts[k])
    times = Counter(r["doc_id"] for r in kept["mixing"])
    assert max(times.values()) <= 2 and set(times) <= set(clean)
    total = sum(len(words(r["text"])) for r in clean.values())
    assert sum(len(words(r["text"])) for r in kept["mixing"]) == pytest.approx(1.5 * total, rel=0.02)
    tokens = Counter()
    for p in kept["packing"]:
        tokens[p["doc_id"]] += p["length"]
    size = {p["doc_id"]: p["doc_tokens"] for p in kept["packing"]}
    assert {k: times[k] * size[k] for k in times} == dict(tokens)


def test_pipeline_of_an_unlabelled_corpus(spark):
    import corpus_pipeline

    docs = odd_documents(spark).select("doc_id", "text", F.when(F.col("doc_id") < 0, "en").alias("lang"), "source", "n_chars")
    kept = corpus_pipeline.by_language(spark, docs, FOLDER)
    lettered = Counter(tuple(r) for r in docs.collect() if any(c.isalpha() for c in r["text"] or ""))
    assert kept.columns == docs.columns and Counter(map(tuple, kept.collect())) == lettered and sum(lettered.values()) == 5
    # A table whose only labelled row is held out: its label stays.
    one = spark.createDataFrame([(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 0), "some words", "en", "a", 10)], docs.schema)
    assert [r["lang"] for r in corpus_pipeline.by_language(spark, one, FOLDER).collect()] == ["en"]
    at = docs
    for name, function in corpus_pipeline.STAGES:
        at = corpus_pipeline.stage(function(spark, at, FOLDER), name)
    assert at.count() > 0


def test_pipeline_of_odd_rows(spark):
    import corpus_pipeline

    docs = odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    assert_own_names_do_not_matter(docs, lambda d: corpus_pipeline.by_language(spark, d, FOLDER))
    for rows in (docs, docs.limit(0)):
        at = rows
        for name, function in corpus_pipeline.STAGES:
            at = corpus_pipeline.stage(function(spark, at, FOLDER), name)
        assert at.count() >= 0
