"""Merge replay, NRA search and the Merkle manifest against the library and brute force."""

import array
import base64
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagic.llm import bpe_replay, catalog, merkle_manifest, nra_search
from pelagic.llm.common import BoundedCache

SF = "/root/testdata/sf0.001"


def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    return c


# ---- merge replay ---------------------------------------------------------

@pytest.fixture(scope="module")
def ranks():
    with open(catalog.byte_ranks(), "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


@pytest.fixture(scope="module")
def library(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=catalog.split_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def replay(ranks):
    return bpe_replay.MergeReplay(ranks)


def random_texts(seed, n):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        picks = [rnd.choice([rnd.randrange(0x110000), rnd.randrange(0x3000), rnd.randrange(128), 32, 10, 39]) for _ in range(rnd.randint(1, 80))]
        out.append("".join(chr(c) for c in picks if not 0xD800 <= c < 0xE000))
    return out


def test_replay_equals_the_library(replay, library, monkeypatch):
    """Any code points (the library's tables decide what is a letter), runs of one sign, long texts, a tiny cache."""
    monkeypatch.setattr(bpe_replay, "STREAMED_CHARS", 20_000)
    enc = bpe_replay.BatchEncoder(replay, bpe_replay.Splitter(catalog.split_pattern()), BoundedCache(50))
    texts = ["", None, "  a\n\n b's don't I'LL 123½ ①", "x" * 30_000, " " * 5000, "é漢字 😀" * 50, "\x00\x1c\x85 z", "aaaa aaa aa", "the cat " * 5000]
    texts += random_texts(1, 800)
    for lo in range(0, len(texts), 300):
        part = texts[lo:lo + 300]
        coded, words = enc.encode(part)
        for t, c in zip(part, coded):
            want = library.encode_ordinary(t or "")
            assert array.array("I", b"".join(words[i][1] for i in c)).tolist() == want
            assert sum(words[i][0] for i in c) == len(want)
            assert b"".join(words[i][2] for i in c) == library.decode_bytes(want)


def test_replay_of_many_words_equals_each_word_alone(replay, ranks):
    """Against plain BPE: of each word the lowest pair merges first, again and again."""
    rnd = random.Random(2)
    words = [bytes(rnd.choice(b"aabcdehinorst ") for _ in range(rnd.randint(0, 30))) for _ in range(400)] + [b"", b"a", b"aaaaaaa"]
    for w, got in zip(words, replay.replay(words)):
        parts = [w[i:i + 1] for i in range(len(w))]
        while len(parts) > 1:
            r, i = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if r == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert got == [ranks[p] for p in parts]
    assert replay.replay([]) == []


def test_ranks_out_of_order_are_refused():
    byte = {bytes([i]): i for i in range(256)}
    with pytest.raises(ValueError):
        bpe_replay.MergeReplay(byte | {b"abcd": 300, b"ab": 301, b"cd": 302})
    lone = bpe_replay.MergeReplay(byte | {b"ab": 256, b"xyz": 257})  # nothing ever makes xyz
    assert lone.replay([b"abxyz"]) == [[256, 120, 121, 122]]


def test_replay_query(spark, library):
    got = {r["doc_id"]: r for r in catalog.QUERIES["op11_bpe_replay"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(array.array("I", ids).tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_replay_columns_nulls_and_round_trip(spark):
    rows = [(1, None, "x", None), (2, "", "y", 1), (3, "A dog, é½😀", "z", 2), (3, "A dog, é½😀", "z", 2), (None, " \n ", "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, `a.b` int")
    path, pattern = catalog.byte_ranks(), catalog.split_pattern()
    out = bpe_replay.byte_decode(bpe_replay.byte_encode(df, path, pattern), path)
    assert out.columns == ["doc_id", "text", "n_tokens", "a.b", "token_ids", "decoded"]
    assert sorted(bytes(r["decoded"]).decode() for r in out.collect()) == sorted(r[1] or "" for r in rows)
    assert bpe_replay.byte_decode(df.select(F.lit(None).cast("array<int>").alias("token_ids")), path).first()["decoded"] is None
    assert bpe_replay.byte_encode(df.limit(0), path, pattern).count() == 0
    again = bpe_replay.byte_encode(df, path, pattern, into="n_tokens")
    assert again.columns == df.columns and again.schema["n_tokens"].dataType.simpleString() == "array<int>"


# ---- oracles --------------------------------------------------------------

@pytest.mark.parametrize("name", ["op12_nra_search", "op13_merkle_intervals"])
def test_oracles(spark, name):
    got = catalog.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con(SF).execute(f"SELECT {', '.join(cols)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*cols).collect())


# ---- ranked search --------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    docs = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in docs:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms_of(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i, s))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, s) for r, (_, _, i, s) in enumerate(scores[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [nra_search.BLOCK_DOCS, 7])
def test_search_against_brute_force(spark, block, monkeypatch):
    """Ties, nulls, repeated rows and queries, hot words, small blocks and depths, a clashing column."""
    monkeypatch.setattr(nra_search, "FIRST_DEPTH", 2)
    monkeypatch.setattr(nra_search, "BLOCK_DOCS", block)
    rnd = random.Random(block)
    words = ["the", "THE", "a", "cat", "Dog", "é1", "x_y", "10", "zebra", "漢字", "sun"]
    docs = [(i, " ".join(rnd.choices(words, weights=[9, 2, 6, 3, 2, 1, 1, 1, 1, 1, 1], k=rnd.randint(1, 25)))) for i in range(180)]
    docs += [(200 + i, "same words, the same WORDS") for i in range(40)]
    docs += [(300, None), (301, ""), (302, " .,;"), (303, "the " * 3000), (None, "the cat"), (7, "the cat"), (7, "the cat")]
    items = [(1, "The cat"), (2, "same same words"), (3, None), (4, ""), (5, "nowhere"), (6, "zebra 漢字 the the a sun é1 dog"), (6, "cat")]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, score int, q string").repartition(5)
    qs = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, nra_search.search(df, qs, 20).collect()), key=str)
    assert got == brute_search(docs, items, 20)
    if block == 7:  # several passes give the same
        assert sorted(map(tuple, nra_search.search(df, qs, 20, block_terms=4).collect()), key=str) == got
    assert nra_search.search(df.limit(0), qs).count() == 0
    assert nra_search.search(df, qs.limit(0)).count() == 0


def test_reading_stops_early_and_finds_all_ties():
    rnd = np.random.default_rng(3)
    for trial in range(60):
        docs, lists = 400, []
        for _ in range(rnd.integers(1, 6)):
            d = rnd.choice(docs, rnd.integers(1, docs), replace=False)
            i = np.sort(rnd.integers(1, 6 if trial % 2 else 5000, len(d)))[::-1].astype(np.int64)
            lists.append((d, i))
        total = np.zeros(docs, np.int64)
        for d, i in lists:
            total[d] += i
        kth = np.sort(total)[-10]
        found, score = nra_search.read_lists(lists, docs, 10, 1)
        assert set(np.flatnonzero((total >= kth) & (total > 0))) <= set(found) and (score == total[found]).all()
    # a clear winner: the tail of the list isn't read
    long = (np.arange(100_000), np.concatenate([[10**6], np.full(99_999, 1)]).astype(np.int64))
    seen = []

    class Probe(np.ndarray):
        def __getitem__(self, k):
            if isinstance(k, slice) and k.stop:
                seen.append(k.stop)
            return super().__getitem__(k)

    found, _ = nra_search.read_lists([(long[0].view(Probe), long[1])], 100_000, 1, 1)
    assert list(found) == [0] and max(seen) <= nra_search.FIRST_DEPTH


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(nra_search, "CHUNK", 5)
    text = "The quick-brown fox, été naïve " * 9 + "x" * 40
    n, found = nra_search.term_counts(text.encode(), {b"the": 0, "été".encode(): 1, b"x" * 40: 2})
    assert n == len(terms_of(text)) and found == {0: 9, 1: 9, 2: 1}


# ---- Merkle manifest ------------------------------------------------------

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(digests):
    """All levels of one tree."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def steps(levels, i):
    out = []
    for row in levels[:-1]:
        lo = i - i % 8
        out.append(("".join(row[lo:i]), "".join(row[i + 1:lo + 8])))
        i //= 8
    return out


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, sha("".join(map(field, r))), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    top = climb([t[-1][0] for t in trees])
    out = []
    for j, g in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = steps(trees[j], i) + steps(top, j)
            own = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                low = None if r[4] is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
                own = sha("".join(map(field, (*r[:4], low))))
            for b, a in path:
                own = sha(b + own + a)
            out.append((r[0], leaf, trees[j][-1][0], top[-1][0], sha("".join(b + a for b, a in path)), own, own == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("langs", [1, 3, 20])
def test_manifest_against_brute_force(spark, tmp_path, langs):
    """One hot group, lone leaves, a null group, null ids, equal ids and rows, empty texts, more than eight groups."""
    rnd = random.Random(langs)
    names = ["en", "é", None, *[f"l{i}" for i in range(20)]][:langs]
    rows = [(i, rnd.choice(["a", None]), "en" if i % 2 else rnd.choice(names), rnd.choice([None, 3]), rnd.choice(["Abc É", "", None, "zz"])) for i in range(150)]
    rows += [(7, None, "en", None, None)] * 3 + [(None, "s", "en", 1, "X"), (None, "s", "en", 1, "Y")]
    if langs > 1:
        rows += [(900, None, "lone", 1, "A")]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, lo int") \
        .repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, catalog.QUERIES["op13_merkle_intervals"](spark, str(tmp_path)).collect()), key=str)
    assert got == brute_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_manifest_of_small_tables(spark, n):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    m = merkle_manifest.manifest(df, df.columns, "lang", "doc_id")
    got = m.withColumn("again", merkle_manifest.fold(F.col("leaf"), F.col("path"))).collect()
    assert len(got) == n and all(r["again"] == r["root"] for r in got)
    assert [r["lo"] for r in sorted(got, key=lambda r: r["doc_id"])] == list(range(n))
    assert sorted((r["doc_id"], r["leaf"], r["root"]) for r in got) == sorted((b[0], b[1], b[3]) for b in brute_manifest(rows))
