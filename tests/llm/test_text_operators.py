"""BPE automaton, language ID, decision lists and the maximum-entropy LM against brute force."""

import hashlib
import math
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pelagic.llm import bpe_automaton, catalog, decision_list, langid, maxent_lm
from pelagic.llm.common import BoundedCache

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(catalog.vocabulary())


@pytest.fixture(scope="module")
def automaton():
    return bpe_automaton.MergeAutomaton.from_file(catalog.vocabulary())


def test_automaton_equals_the_library(automaton, library):
    rnd = random.Random(3)
    texts = ["", "  \n", "aaaaaaa aaaa bananananana", "I'm don't it's we'LL", "ΟΔΟΣ Σίσυφος", "<|endoftext|>a<|startoftext|> b",
             "x\x1cy 123 ½ ①", "é é", "漢字 😀😀", "a b c　d\x85e", "the " * 500]
    texts += ["".join(rnd.choice("aabcdeinorstth  ' .") for _ in range(80)) for _ in range(400)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert automaton.encode(t) == want, t
        assert automaton.decode(want) == library.decode(want, skip_special_tokens=False)


def test_automaton_has_one_path_per_string():
    """Every split of a string into tokens but the encoding breaks an arc."""
    sym = bpe_automaton.byte_symbols()
    vocab = {s: i for i, s in enumerate(sym)} | {s + "#": 256 + i for i, s in enumerate(sym)}
    merges = [("a", "a"), ("b", "a"), ("aa", "ba"), ("a", "b"), ("aa", "b#"), ("b", "b#")]
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    m = bpe_automaton.MergeAutomaton(vocab, merges, "#", {}, r"\S+")
    rnd = random.Random(5)
    for _ in range(200):
        w = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 7)))
        ids = m.encode_piece(w)
        assert "".join(m.decode(ids).split(" ")) == w + "#"
        # plain BPE: rule by rule, left to right
        parts = [*w[:-1], w[-1] + "#"]
        for a, b in merges:
            out = []
            for p in parts:
                if out and out[-1] == a and p == b:
                    out[-1] = a + b
                else:
                    out.append(p)
            parts = out
        assert [m.label[i] for i in ids] == parts


def test_bpe_query(spark, library):
    got = {r["doc_id"]: r for r in catalog.QUERIES["op2_bpe_automaton"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_columns_nulls_and_round_trip(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "a dog", "z"), (3, "a dog", "z")], "doc_id long, text string, n_tokens string")
    out = bpe_automaton.bpe_decode(bpe_automaton.bpe_encode(df, catalog.vocabulary()), catalog.vocabulary())
    rows = out.orderBy("doc_id").collect()
    assert out.columns == ["doc_id", "text", "n_tokens", "token_ids", "decoded"]
    assert [r["decoded"] for r in rows] == ["", "", "a</w> dog</w>", "a</w> dog</w>"]
    assert bpe_automaton.bpe_encode(df.limit(0), catalog.vocabulary()).count() == 0


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = catalog.QUERIES["op3_language_id"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    j = got.join(docs, "doc_id").filter("held_out and lang is not null")
    n, right = j.count(), j.filter("lang_pred = lang").count()
    assert n > 100 and right >= 0.97 * n
    assert got.filter("score < 0 or score > 1").count() == 0
    for r in got.select("doc_id", "held_out").limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_language_backoff_and_edges(spark):
    train = [(i, "der hund und die katze laufen", "de") for i in range(9)] + [(9 + i, "the dog and the cat run", "en") for i in range(9)]
    df = spark.createDataFrame([*train, (99, None, "en"), (98, "und the", None)], "doc_id long, text string, lang string")
    m = langid.train(df)
    assert m.langs == ["de", "en"]
    p = lambda t: m.predict(t, BoundedCache(9), 20)
    assert p("die katze")[0] == "de" and p("the cat")[0] == "en"
    assert p("hundkatze")[0] == "de" and p("dogcat")[0] == "en"  # unseen words: by their n-grams
    assert p(None) == p("") == p("123 !!") == ("und", 0.0)
    assert p("жжж")[1] == 0.5  # nothing known: a tie, smaller name
    empty = langid.train(df.limit(0))
    assert empty.predict("the", BoundedCache(9), 20) == ("und", 0.0)
    out = langid.predict_language(spark.createDataFrame([(1, "the", "a"), (1, "the", "a"), (None, None, None)], "doc_id long, text string, score string"), m)
    assert out.columns == ["doc_id", "text", "score", "language"] and out.count() == 3


def naive_language(train, text, max_words, max_grams, evidence):
    """Prediction and score by plain dictionaries."""
    def shares(counts, keep):
        total = sum(counts.values())
        return {g: c / total for g, c in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:keep]}

    def letters(t):
        return "".join(c if unicodedata.category(c)[0] == "L" else " " for c in t.lower()).split()

    langs = sorted({lang for _, lang in train})
    words, grams = {}, {}
    for x in langs:
        seen = Counter(w for t, lang in train if lang == x for w in letters(t))
        words[x] = shares(seen, max_words)
        for n in range(1, 7):
            of = Counter()
            for w, c in seen.items():
                for i in range(len(w) + 3 - n):
                    of[f" {w} "[i:i + n]] += c
            del of[" "]
            grams[x, n] = shares(of, max_grams)
    rarest = [1 - math.log10(min(v for d in ds for v in d.values())) for ds in (words.values(), grams.values())]
    total, told = dict.fromkeys(langs, 0.0), 0
    for w in letters(text):
        parts = [(w, words)] if any(w in words[x] for x in langs) else []
        for n in (6, 5, 4, 3, 2, 1):
            if not parts:
                own = {x: grams[x, n] for x in langs}
                parts = [(g, own) for i in range(len(w) + 3 - n) if any((g := f" {w} "[i:i + n]) in own[x] for x in langs)]
        for x in langs:
            for g, own in parts:
                total[x] += (-math.log10(own[x][g]) if g in own[x] else rarest[own is not words]) / len(parts)
        told += bool(parts)
    if not letters(text):
        return "und", 0.0
    mean = {x: total[x] / max(told, 1) for x in langs}
    best = min(langs, key=lambda x: (round(mean[x], 9), x))
    return best, 1 / sum(10 ** ((mean[best] - mean[x]) * min(told, evidence)) for x in langs)


def test_language_against_brute_force(spark):
    rnd = random.Random(4)
    stems = {x: ["".join(rnd.choices(alphabet, k=rnd.randint(1, 7))) for _ in range(40)]
             for x, alphabet in (("aa", "abcdef"), ("bb", "bcdxyz"), ("cc", "éàñabc"), ("dd", "жшюab"))}
    train = [(i, " ".join(rnd.choices(stems[x], k=12)), x) for i, x in enumerate(rnd.choices(list(stems), k=120))]
    m = langid.train(spark.createDataFrame(train, "doc_id long, text string, lang string"), max_words=25, max_grams=30)
    cache = BoundedCache(50)
    odd = ["½ ² Ⅷ ①", "½a", "一二", "abc1def", "жж_ш", "12 34", "\u0f33"]
    for text in [*odd, *[" ".join(rnd.choices([w + rnd.choice(["", "", "q", "ab"]) for w in sum(stems.values(), [])], k=rnd.randint(1, 9)))
                         for _ in range(150)]]:
        got, want = m.predict(text, cache, 20), naive_language([(t, x) for _, t, x in train], text, 25, 30, 20)
        assert got[1] == pytest.approx(want[1], rel=1e-6), text
        assert got[0] == want[0] or want[1] < 0.5 + 1e-6  # equal but for rounding
    assert m.predict("½ ² Ⅷ ①", cache, 20) == ("und", 0.0) and m.predict("一", cache, 20)[0] == "aa"


def test_language_of_many_labels(spark):
    rows = [(i, f"word{chr(97 + i // 26 % 26)}{chr(97 + i % 26)} common", f"l{i:03d}") for i in range(300)]
    m = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_entries=300 * 20)
    assert len(m.langs) == 300 and len(m.words.lang) == 600
    cache = BoundedCache(50)
    assert all(m.predict(t, cache, 20)[0] == x for _, t, x in rows)


def naive_stats(text):
    words = decision_list.WORDS.findall(text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = [], 0
    for line in (text or "").split("\n"):
        if decision_list.WORDS.search(line):
            dup += line in seen
            seen.append(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside))


def test_statistics_against_brute_force():
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "a b c", "x\n\nx\n \nx", "a b c d e a b c d e f"]
    texts += ["".join(rnd.choice(["a ", "b ", "c\n", "#d ", "é|"]) for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    for t in texts:
        assert decision_list.stats_of(t)[:5] == naive_stats(t), t
    ids = np.array([rnd.randrange(9000) for _ in range(5000)] * 2)  # too many distinct ids to pack five at once
    assert decision_list.repeated_positions(ids) == 10000


def test_learned_rules_are_conditions_that_spark_and_numpy_agree_on(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rules = decision_list.learn(docs, labels)
    assert rules.rules and str(rules).endswith("else keep")
    out = decision_list.judge(docs.select("doc_id", "text", F.lit(1).alias("n_words")), rules)
    assert out.columns == ["doc_id", "text", "n_words", "quality_rules"]
    j = out.join(labels, "doc_id").select("quality", "quality_rules.kept", "quality_rules.base_failed").toPandas()
    good = j[(j.quality == 1) & ~j.base_failed]
    assert good.kept.mean() > 0.99
    assert (~j[j.quality == 0].kept).mean() > 0.95
    for r in out.limit(60).collect():
        assert tuple(r["quality_rules"])[:5] == naive_stats(r["text"])


def test_covering_recovers_a_conjunction():
    rnd = np.random.default_rng(2)
    x = {"a": rnd.random(3000), "b": rnd.random(3000), "c": rnd.random(3000)}
    bad = (x["a"] > 0.7) & (x["b"] <= 0.4)
    rules = decision_list.cover(x, bad, np.arange(3000) % 3)
    assert (rules.keeps(x) == ~bad).mean() > 0.98
    assert not decision_list.cover(x, np.zeros(3000, bool), np.arange(3000) % 3).rules


def test_rules_without_labels_keep(spark):
    docs = spark.createDataFrame([(1, None), (2, "a " * 20), (3, " ".join(map(str, range(20))))], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 0)], "doc_id long, quality int")
    out = decision_list.judge(docs, decision_list.learn(docs, labels)).orderBy("doc_id").select("quality_rules.*").collect()
    assert [r["kept"] for r in out] == [False, False, True]
    assert [r["base_failed"] for r in out] == [True, True, False]


def lm_tokens(text):
    return [*decision_list.WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or "")), maxent_lm.END]


def naive_base(texts, train):
    c = Counter(w for t in train for w in lm_tokens(t))
    n, v = sum(c.values()), len(c)
    return [(len(toks := lm_tokens(t)), sum(c[w] > 0 for w in toks), n,
             sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in toks)) for t in texts]


@pytest.mark.parametrize("head", [100_000, 40])
def test_lm_counts_and_base(spark, head):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**6, None), (10**6, None), (10**6 + 1, ""), (None, "Of THE thé")], "doc_id long, text string"))
    rows = docs.collect()
    train = [r["text"] for r in rows if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1]
    model, counts = maxent_lm.train(docs.filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 1),
                                    shape=maxent_lm.Shape(head=head, model_words=64, class_size=8))
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                 for r in maxent_lm.score_texts(docs, model, counts).collect())
    want = naive_base([r["text"] for r in rows], train)
    assert got == sorted((r["doc_id"] or -1, *w[:3], round(w[3], 6)) for r, w in zip(rows, want))


def test_lm_is_a_distribution():
    """Given any history, the probabilities of all training tokens and of one unseen token add up to 1."""
    words = [f"w{i}" for i in range(30)]
    head = [(maxent_lm.END, 50), *[(w, 40 - i) for i, w in enumerate(words)]]
    n, v = sum(c for _, c in head), len(head)
    m = maxent_lm.MaxEnt(head, n, v, maxent_lm.Shape(model_words=16, class_size=4))
    m.weights = np.random.default_rng(0).normal(0, 0.5, len(m.weights)).astype(np.float32)
    ids, start, total = {w: i for i, (w, _) in enumerate(head)}, m.start, 0.0
    for k in range(len(ids)):
        codes = np.array([start, start, start, ids["w3"], ids["w20"], k])
        p = math.exp(m.score(codes)[-1])
        total += p * (10 ** m.rest_log[k] if k >= m.model_words else 1)
    codes[-1] = len(ids)
    total += math.exp(m.score(codes)[-1]) * 0.5 / (m.rest_n + 0.5 * (m.rest_v + 1))
    assert abs(total - 1) < 1e-4


def test_lm_scores_and_steps_against_plain_softmaxes():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    head = [(maxent_lm.END, 50), *[(w, 90 - 2 * i) for i, w in enumerate(words)]]
    n, v = sum(c for _, c in head) + 60, len(head) + 40
    m = maxent_lm.MaxEnt(head, n, v, maxent_lm.Shape(class_size=4, bits=6))
    m.weights = np.random.default_rng(3).normal(size=len(m.weights)).astype(np.float32)
    m.weights[7] = 500  # a logit beyond 32-bit powers
    texts = pa.array([" ".join(rnd.choices([*words, "rare", "odd"], k=rnd.randint(0, 40))) for _ in range(30)])
    codes = m.code(texts)[0]

    def hashed(bits, salt, *parts):
        h = (salt + 1) * 0x9E3779B97F4A7C15 % 2**64
        for x in parts:
            h = (h ^ int(x)) * 0x9E3779B97F4A7C15 % 2**64
            h ^= h >> 29
        return h * 0x9E3779B97F4A7C15 % 2**64 >> 64 - bits

    def choices(k):
        past = [hashed(64, i, *(codes[k - d] for d in back)) for i, back in enumerate([(1,), (2, 1), (2,), (3,)], 1)]
        for node, place in zip(m.path[m.leaf[codes[k]]], m.place[m.leaf[codes[k]]]):
            if node >= 0:
                own = hashed(64, 5, node)
                rows = [((own ^ h) * 0x9E3779B97F4A7C15 % 2**64) >> 64 - 6 for h in past]
                z = [min(80.0, float(m.bias[node][a]) + sum(float(m.weights[4 * r + a]) for r in rows)) for a in range(4)]
                total = sum(math.exp(x) for x in z)
                yield rows, [math.exp(x) / total for x in z], place, z[place] - math.log(total)

    targets = [k for k in range(len(codes)) if codes[k] != m.start]
    got = m.score(codes)
    for k in range(len(codes)):
        assert got[k] == pytest.approx(sum(c[3] for c in choices(k)) if k in targets else 0, rel=1e-4, abs=1e-4)
    slope = np.zeros(len(m.weights))
    for k in targets:
        for rows, shares, place, _ in choices(k):
            for r in rows:
                for a in range(4):
                    slope[4 * r + a] += shares[a] - (a == place)
    weights, square = m.weights.copy(), np.zeros_like(m.weights)
    assert m.step(weights, square, codes, 0.5) == len(targets)
    moved = m.weights - 0.5 * slope / np.sqrt(slope**2 + maxent_lm.DAMPING)
    assert weights == pytest.approx(moved, rel=1e-3, abs=1e-3)


def test_lm_covers_the_whole_vocabulary(spark):
    """Tokens beyond the 512 commonest, and classes of tokens outside the head, are told from their history."""
    rnd = random.Random(3)
    pairs = [(f"a{i}x", f"b{i}y") for i in range(700)]  # each second word follows from its first
    rows = [(i, " ".join(w for _ in range(40) for w in rnd.choice(pairs))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, _ = maxent_lm.train(docs)
    assert model.model_words == len(model.vocab) == 1401
    codes = model.code(pa.array([rows[0][1]]))[0]
    first = [float(x) for x in model.score(codes)[3:-1:2]]
    second = [float(x) for x in model.score(codes)[4:-1:2]]
    assert np.mean(second) > np.mean(first) + 1
    # a history changes the class of tokens outside the head, and everything still adds up to 1
    model, counts = maxent_lm.train(docs, shape=maxent_lm.Shape(head=300))
    inside = {r["token"]: r["c"] for r in counts.collect()}
    assert len(model.vocab) <= 300 and len(set(model.leaf)) > 4000
    for before in (rows[0][1].split()[:2], ["b1y", "a7x"]):
        history = model.code(pa.array([" ".join(before)]))[0][3:5]
        codes = np.concatenate([np.r_[model.start, history, k] for k in range(model.start)])
        p = np.exp(model.score(codes)[3::4])
        leaves = dict(zip(model.leaf, p))
        assert abs(sum(leaves.values()) - 1) < 1e-3
    share = defaultdict(float)
    for w, c in inside.items():
        code = int(model.code(pa.array([w]))[0][3])
        if code >= len(model.vocab):
            share[model.kind[code]] += (c + 0.5) / model.class_total[model.kind[code]]
    assert share and all(abs(x + 0.5 / model.class_total[k] - 1) < 1e-9 for k, x in share.items())


def test_lm_beats_the_base_on_held_out_texts(spark):
    r = catalog.QUERIES["op5_maxent_lm"](spark, "/root/testdata/sf0.01").filter("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


def test_lm_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model, counts = maxent_lm.train(docs.limit(0))
    rows = maxent_lm.score_texts(docs, model, counts).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]


def test_cache_is_bounded_and_keeps_what_is_used():
    c = BoundedCache(10)
    for i in range(1000):
        if c.get("hot") is None and c.recall("hot") is None:
            assert i == 0
            c["hot"] = 1
        c[i] = i
        assert len(c) + len(c.old) <= 20
