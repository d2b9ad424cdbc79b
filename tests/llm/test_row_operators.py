"""Top-k, SimHash, URL globs, sharding, mixing and HTML extraction against brute force; the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pelagic.llm import catalog, external_shuffle, html_style_tree, pfair_mix, segment_topk, simhash_gph, url_glob

SF = "/root/testdata/sf0.001"


def con(sf):
    import os

    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    return c


@pytest.mark.parametrize("name", ["op7_segment_topk", "op9_url_glob"])
def test_oracles(spark, name):
    sf = "/root/testdata/sf0.01"
    got = catalog.QUERIES[name](spark, sf)
    c = con(sf)
    c.execute(f"CREATE VIEW o AS {catalog.ORACLES[name]}")
    cols = sorted(got.columns)
    assert cols == sorted(x[0] for x in c.execute("DESCRIBE o").fetchall())
    want = c.execute(f"SELECT {', '.join(cols)} FROM o").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*cols).collect())


# ---- exact top-k ----------------------------------------------------------

def test_topk_against_brute_force(spark):
    rnd = np.random.default_rng(4)
    vecs = [(i, rnd.normal(0, 0.3, 13).tolist()) for i in range(400)]
    vecs += [(400 + i, [0.5] * 13) for i in range(60)]  # many ties
    vecs += [(600, None), (601, [None] * 13), (602, [float("nan")] * 13), (603, [float("inf")] * 13), (None, [0.1] * 13), (604, [0.9] * 5),
             (650, [0.9] * 5), (700, []), (750, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in vecs], "vec_id long, embedding array<double>, score string")
    got = segment_topk.top_k(df, df.filter("vec_id % 50 = 0"), candidate_tile=70, query_tile=4).collect()
    ok = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in vecs
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in ok:
        if q % 50 == 0:
            s = sorted((-int(a @ b), i) for i, b in ok if i != q and len(a) == len(b))[:5]
            want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert segment_topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_segment_bound_never_below_the_score():
    rnd = np.random.default_rng(5)
    x = rnd.integers(-300, 300, (50, 17)).astype(float)
    for s in (1, 2, 8, 16, 17, 40):
        f = segment_topk.segment_features(x, s)
        assert (f @ f.T >= x @ x.T - 1e-6).all()


# ---- SimHash --------------------------------------------------------------

def naive_print(text, k=4):
    words = re.findall(simhash_gph.WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def naive_components(ids, prints, limit=4):
    up = list(range(len(ids)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= limit:
                up[find(i)] = find(j)
    least = defaultdict(list)
    for i, d in enumerate(ids):
        least[find(i)].append(d)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(ids))]


def test_fingerprints_equal_sparks_hash_and_brute_force(spark):
    rnd = random.Random(0)
    texts = [None, "", " \t", "One", "a b c", "a b c d", "É Ü x Y z"] + [" ".join(rnd.choices("abcdefg", k=rnd.randint(1, 40))) for _ in range(60)]
    for t in texts:
        assert simhash_gph.fingerprint(t, 4) == naive_print(t)
    r = spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first()
    assert r["h"] % (1 << 64) == xxhash.xxh64_intdigest("a b c d", seed=42)


@pytest.mark.parametrize("hot", [20_000, 8])
def test_links_connect_like_all_pairs(spark, hot):
    """Random clusters, chains and bits that most fingerprints share; small ``hot`` refines the buckets again and again."""
    rnd = random.Random(hot)
    base = rnd.getrandbits(64)
    fps = {0, 1, 3, (1 << 64) - 1}
    for _ in range(60):
        f = rnd.getrandbits(64) if rnd.random() < 0.5 else base ^ (rnd.getrandbits(64) & 0xFFFF)
        for _ in range(rnd.randint(1, 8)):
            fps.add(f)
            for b in rnd.sample(range(64), rnd.randint(0, 4)):
                f ^= 1 << b
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash_gph.signed(f),) for f in fps], "fp long")
    links = simhash_gph.near_links(df, 4, hot_bucket=hot).collect()
    for r in links:
        assert ((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 4
    root = {r["node"]: r["root"] for r in simhash_gph.connected(spark.createDataFrame(links, "a long, b long")).collect()} if links else {}
    got = [root.get(simhash_gph.signed(f), simhash_gph.signed(f)) for f in fps]
    assert got == naive_components([simhash_gph.signed(f) for f in fps], fps)


def test_thresholds_meet_the_generalised_pigeonhole():
    rnd = np.random.default_rng(1)
    sample = rnd.integers(0, 1 << 63, 300, dtype=np.uint64)
    for n in (100, 10**6, 10**10):
        for parts in (1, 2, 3, 4, 5):
            groups = simhash_gph.group_bits(sample, parts)
            assert sorted(b for g in groups for b in g) == list(range(64))
            _, t = simhash_gph.allocate(sample, groups, n, 5)
            assert sum(x + 1 for x in t) == 5 and min(t) >= -1


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in catalog.QUERIES["op8_simhash_gph"](spark, SF).collect()}
    prints = [naive_print(d["text"]) for d in docs]
    want = naive_components([d["doc_id"] for d in docs], prints)
    assert len(got) == len(docs)
    for d, p, c in zip(docs, prints, want):
        assert (got[d["doc_id"]]["fingerprint"], got[d["doc_id"]]["component_id"]) == (f"{p:016x}", c)


def test_simhash_edges_and_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(300))
    near = text + " w300"
    rows = [(5, text, "a"), (3, text, "b"), (3, text, "b"), (9, near, None), (None, text, "c"), (7, None, "d"), (8, "", "e"),
            (None, "quite another text of a few words", "f"), (None, "quite another text of a few words", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash_gph.components(df).collect())
    near_too = (naive_print(text) ^ naive_print(near)).bit_count() <= 4
    assert got == Counter({(5, 3): 1, (3, 3): 2, (9, 3 if near_too else 9): 1, (None, 3): 1, (7, 7): 1, (8, 7): 1, (None, None): 2})
    kept = simhash_gph.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or -1, r["fp"]) for r in kept.collect()) == sorted(
        [(3, "b"), (7, "d"), (-1, "f"), *([] if near_too else [(9, None)])], key=lambda x: x[0])
    assert simhash_gph.components(df.limit(0)).count() == 0


# ---- URL globs ------------------------------------------------------------

def glob_regex(g):
    out = ""
    for part in re.split(r"(\*+|\?)", g):
        out += ("(?s:.*)" if "**" in part else "[^/]*") if part.startswith("*") else "[^/]" if part == "?" else re.escape(part)
    return re.compile(out + r"\Z")


def test_globs_against_regular_expressions():
    rnd = random.Random(9)
    alphabet = "ab/.é"
    globs = ["", "*", "**", "?", "a*b", "**/b", "a?b*", "*.a/**", "a" * 70 + "*b"]
    globs += ["".join(rnd.choice(["a", "b", "/", ".", "*", "**", "?"]) for _ in range(rnd.randint(1, 9))) for _ in range(120)]
    texts = ["", "a" * 70 + "xb", "a" * 5000 + "/b"] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    got = url_glob.GlobAutomaton(globs).match(texts)
    for j, g in enumerate(globs):
        r = glob_regex(g)
        for i, t in enumerate(texts):
            assert got[i, j] == bool(r.match(t)), (g, t)


def test_url_rules(spark):
    rules = [url_glob.site_rule(s, v) for s, v in catalog.SITE_RULES] + [url_glob.host_glob("*spam*", "block")]
    cases = {None: (None, "allow"), "no scheme": (None, "allow"), "http://A.NET": (None, "allow"), "http://A.NET/": ("net/", "block"),
             "https://x.example.net/en/1?q#f": ("example.net/en/", "allow"), "https://example.net/EN/": ("net/", "block"),
             "https://badexample.com/de/": (None, "allow"), "https://example.com/de/": ("example.com/de/", "block"),
             "https://o.org/fr/x": ("org/fr/", "allow"), "https://o.org/x.net/": (None, "allow"), "http://my-spam.org/": ("*spam*", "block"),
             "http://a.b/spam": (None, "allow"), "http://h?x://y.net/": (None, "allow"), "a://b.net:80/": (None, "allow")}
    df = spark.createDataFrame([(u, "h") for u in [*cases, "http://A.NET/"]], "url string, host string")
    out = url_glob.judge_urls(df, rules)
    assert out.columns == ["url", "host", "url_filter"] and out.count() == len(cases) + 1
    assert {r["url"]: (r["url_filter"]["rule"], r["url_filter"]["verdict"]) for r in out.collect()} == cases
    assert {r["url_filter"]["host"] for r in out.filter("url is null or url = 'no scheme'").collect()} == {""}


# ---- sharding -------------------------------------------------------------

def test_sharding_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.QUERIES["op10_external_shuffle"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        t = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t) + 16, zlib.crc32(t), "key")
        assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = catalog.QUERIES["op10_external_shuffle"](spark.newSession(), SF)
    assert {(r["doc_id"], r["slot"]) for r in again.collect()} == {(r["doc_id"], r["slot"]) for r in rows}


def test_sharding_in_many_buckets_with_nulls(spark, tmp_path):
    rows = [(i % 50 if i % 7 else None, None if i % 11 == 0 else "x" * (i % 30), "s") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string").repartition(5)
    out = external_shuffle.external_shuffle(df, 3, bucket_bytes=200)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(r[:2] for r in rows)
    assert len({r["__bucket"] for r in got}) > 10
    for s in {r["__shard"] for r in got}:
        assert sorted(r["__slot"] for r in got if r["__shard"] == s) == list(range(sum(r["__shard"] == s for r in got)))
    assert len({r["__shard"] for r in got if r["doc_id"] == 4}) == 1
    external_shuffle.write_shards(df.drop("slot"), str(tmp_path / "w"), 3, bucket_bytes=200)
    assert spark.read.parquet(str(tmp_path / "w")).count() == 500
    assert external_shuffle.external_shuffle(df.limit(0), 3).count() == 0


def test_sharding_spreads_one_id_and_copies_of_one_row(spark):
    rows = [(7, f"text {i}" * 3) for i in range(1500)] + [(7, "copy" * 6)] * 1500 + [(i, "other") for i in range(100, 1600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = external_shuffle.external_shuffle(df, 4, bucket_bytes=4000).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    assert len({r["__shard"] for r in got if r["doc_id"] == 7}) == 1
    for hot in ([r for r in got if r["doc_id"] == 7], [r for r in got if r["text"] == "copy" * 6]):
        of = Counter(r["__bucket"] for r in hot)
        assert len(of) > 15 and max(of.values()) < 0.15 * len(hot)
    assert max(Counter((r["__shard"], r["__bucket"]) for r in got).values()) < 400
    for s in range(4):
        assert sorted(r["__slot"] for r in got if r["__shard"] == s) == list(range(sum(r["__shard"] == s for r in got)))
    few = external_shuffle.external_shuffle(df, 4, bucket_bytes=4000, most_buckets=8).select("__shard", "__bucket").distinct()
    assert few.count() <= 12


def test_sharding_and_urls_with_clashing_columns(spark):
    df = spark.createDataFrame([(i, "a", 1, 2, 3, f"k{i}", 5, 6) for i in range(40)],
                               "doc_id long, text string, __shard int, __slot int, __n int, __Key string, __row int, __place int")
    got = external_shuffle.external_shuffle(df, 3)
    assert got.columns == ["doc_id", "text", "__n", "__Key", "__row", "__place", "__shard", "__bucket", "__slot"]
    assert all((r["__n"], r["__Key"], r["__row"], r["__place"]) == (3, f"k{r['doc_id']}", 5, 6) for r in got.collect())
    urls = spark.createDataFrame([("http://a.net/x", "kept", "p", 1)], "url string, __h string, __P string, __v int")
    out = url_glob.judge_urls(urls, [url_glob.site_rule("net/", "block")])
    assert out.columns == ["url", "__h", "__P", "__v", "url_filter"]
    r = out.first()
    assert (r["__h"], r["__P"], r["__v"], r["url_filter"]["verdict"]) == ("kept", "p", 1, "block")
    assert url_glob.judge_urls(urls.limit(0), []).count() == 0


def test_fisher_yates_is_a_uniform_permutation():
    assert list(external_shuffle.fisher_yates(0, 1)) == []
    seen = Counter(tuple(external_shuffle.fisher_yates(3, 1, k)) for k in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850


# ---- mixing ---------------------------------------------------------------

def test_pfair_windows_and_deviation(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choices(["a", "b", "c", None], [50, 10, 3, 5])[0]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string").withColumn("slot", F.lit("x"))
    out = pfair_mix.pfair_mix(df, {"a": 0.5}, block_docs=4, quantum=128)
    assert out.columns == ["doc_id", "source", "slot", "mix"]
    got = [(r["doc_id"], r["source"], *r["mix"]) for r in out.collect()]
    assert sorted(g[0] for g in got) == list(range(3000))
    blocks = {(s, b): (ph, rel, dl, sl) for _, s, ph, b, rel, dl, sl, _ in got}
    assert len({v[3] for v in blocks.values()}) == len(blocks) == max(v[3] for v in blocks.values()) + 1  # every slot once
    assert all(rel <= sl < dl for _, rel, dl, sl in blocks.values())
    assert len({g[7] for g in got}) == len(got)
    # deviation in the first phase, against the weights asked for
    first = sorted((v[3], s) for (s, _), v in blocks.items() if v[0] == 0)
    share = pfair_mix.whole_shares({"a": 0.5, "b": 0.2, "c": 0.3}, 128)
    assert sum(share.values()) == 128
    had = sum(s == "a" for _, s in first)
    assert abs(had - 0.5 * len(first)) < 1
    for t in range(len(first)):
        assert abs(sum(s == "a" for _, s in first[:t]) - 0.5 * t) < 1


def test_period_has_less_than_one_block_of_deviation():
    rnd = random.Random(6)
    for _ in range(30):
        w = {str(i): rnd.random() ** 3 + 1e-3 for i in range(rnd.randint(1, 12))}
        share = pfair_mix.whole_shares(w, 256)
        slots = pfair_mix.edf_period(share)
        total = sum(share.values())
        at = {t: s for s, ts in slots.items() for t in ts}
        assert sorted(at) == list(range(total))
        had = Counter()
        for t in range(total):
            had[at[t]] += 1
            assert all(abs(had[s] * total - a * (t + 1)) < total for s, a in share.items())


def test_exact_weights_over_many_periods():
    """0.3 and 0.0001 are no multiples of 1/2048: the lag stays below one block far beyond one period, and after run-outs."""
    from fractions import Fraction

    target = pfair_mix.target_weights(dict.fromkeys("abcd", 1), {"a": 0.3, "b": 0.0001, "c": 0.2}, 0.5)
    assert target["a"] == Fraction(3, 10) and target["b"] == Fraction(1, 10000) and sum(target.values()) == 1
    w = pfair_mix.whole_weights([target[s] for s in "abcd"])
    for blocks in ([18_100, 12, 20_000, 30_000], [3_000, 40, 6, 9_000]):
        targets = pfair_mix.Targets(blocks, w)
        ranges = list(pfair_mix.range_starts(targets, 5000))
        rows = []
        for start, stop, done in ranges:
            rows += pfair_mix.schedule(targets, np.frombuffer(done, dtype=np.int64).tolist(), start, stop)
        assert [r[4] for r in rows] == list(range(sum(blocks)))
        assert Counter(r[0] for r in rows) == dict(enumerate(blocks)) and len({r[:2] for r in rows}) == len(rows)
        assert all(release <= slot < deadline for _, _, release, deadline, slot in rows)
        # against the fluid target, advanced slot by slot in floats
        had, want = [0] * 4, [0.0] * 4
        for s, *_ in rows:
            had[s] += 1
            room = 1.0
            while room > 1e-12 and any(n - x > 1e-9 for n, x in zip(blocks, want)):
                live = [k for k in range(4) if blocks[k] - want[k] > 1e-9]
                total = sum(w[k] for k in live)
                part = min([room, *[(blocks[k] - want[k]) * total / w[k] for k in live]])
                for k in live:
                    want[k] += part * w[k] / total
                room -= part
            assert all(abs(had[k] - want[k]) < 1 + 1e-6 for k in range(4))


def test_mix_follows_uneven_weights_beyond_a_period(spark):
    df = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20_000, "a").when(F.col("id") < 20_020, "b").otherwise("c").alias("source"))
    got = pfair_mix.pfair_mix(df, {"a": 0.3, "b": 0.0001}, block_docs=1).select("source", "mix.*").collect()
    assert sorted(r["slot"] for r in got) == list(range(60_000))
    first = [r["source"] for r in sorted(got, key=lambda r: r["slot"]) if r["phase"] == 0]
    assert len(first) > 50_000
    a = b = 0
    for t, s in enumerate(first, 1):
        a, b = a + (s == "a"), b + (s == "b")
        assert abs(a - 0.3 * t) < 1 and abs(b - 0.0001 * t) < 1


def test_mix_of_nothing_and_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a", "t")] * 30 + [(None, None, None)] * 5, "doc_id long, source string, text string")
    got = pfair_mix.pfair_mix(df).collect()
    assert len(got) == 35 and len({r["mix"]["position"] for r in got}) == 35
    assert pfair_mix.pfair_mix(df.limit(0)).count() == 0


# ---- HTML -----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header>Site</header><nav><ul><li>x</ul></nav><!-- <p>no</p> --><div class="ad">Ad</div><div class="cookie-notice">We <b>use</b></div>
<article><header><h1>One &amp; two</h1></header><p><b>First   line
here.<br><p>Caf&eacute;&nbsp;x<p hidden>no</p><div class="share-buttons">Share</div><ul><li>i<li>j <i>k</i></ul>
<section id="comments"><h2>Comments</h2><p>nice</p></section><form><p>Mail</p></form></article><aside><p>rel</p></aside>
<footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert html_style_tree.main_text(PAGE, set()) == "One & two\nFirst line here.\nCafé x\ni\nj k"
    assert html_style_tree.main_text(None, set()) == html_style_tree.main_text("", set()) == ""
    assert html_style_tree.main_text("plain <b>te</b>xt &lt;", set()) == "plain text <"
    assert html_style_tree.main_text("<article><p>a<script>x", set()) == "a"
    assert html_style_tree.main_text("<article><p>a <b>b<i>c</b>d</i>e</article><p>z", set()) == "a bcde"
    assert html_style_tree.main_text("<p>" + "w " * 50_000, set()) == ("w " * 50_000).strip()


def test_extraction_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = catalog.QUERIES["op1_site_style_tree"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S).group(1)
        parts = [" ".join(html_style_tree.entities.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", body)]
        assert r["text"] == "\n".join(p for p in parts if p)
        assert (r["url"], r["n_chars"]) == (pages[r["page_id"]]["url"], len(r["text"]))


def test_style_tree_cuts_what_a_site_repeats(spark):
    """No article mark-up: the same boxes on every page of a host go, also where one host has most pages."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        host = "http://big.org" if i < 40 else "http://small.org" if i < 57 else "http://rare.org"
        own = " ".join(rnd.choices(words, k=30))
        rows.append((f"{host}/{i}", f"<div class=x1>All stories</div><div class=x2><p>{own}</p><p>more {i}</p></div><div class=x3><span>About us</span></div>", own, i))
    rows += [rows[0][:3] + (0,)] * 5  # copies
    df = spark.createDataFrame([(u, h, "t") for u, h, _, _ in rows] + [(None, None, "t"), ("http://big.org/e", "", "t")], "url string, html string, host string")
    got = html_style_tree.extract_text(df).collect()
    text = {r["url"]: r["main_text"] for r in got}
    assert len(got) == len(rows) + 2 and text[None] == "" and text["http://big.org/e"] == ""
    for u, _, own, i in rows:
        want = f"{own}\nmore {i}"
        assert text[u] == (f"All stories\n{want}\nAbout us" if "rare" in u else want)
    assert html_style_tree.extract_text(df.limit(0)).count() == 0
    wide = html_style_tree.extract_text(df, broadcast_hosts=0).collect()  # the shuffle way
    assert sorted((r["url"] or "", r["main_text"]) for r in wide) == sorted((r["url"] or "", r["main_text"]) for r in got)


def test_style_tree_judges_what_articles_repeat(spark):
    """Paragraphs under neutral classes that all pages of a host repeat inside their article or main part go; own ones stay."""
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    want, rows = {}, []
    for host, n, tag in (("many.org", 30, "article"), ("four.org", 4, "main"), ("three.org", 3, "article")):
        for i in range(n):
            own = [" ".join(rnd.choices(words, k=20)) for _ in range(2)]
            url = f"http://{host}/{i}"
            rows.append((url, f"<{tag}><h1>Title {i}</h1><p class=x1>Read this first</p><p>{own[0]}</p><p>{own[1]}</p>"
                              f"<ul class=x2><li>One</li><li>Two</li></ul><p class=x3>part {i % 2}</p></{tag}>"))
            first, last = (["Read this first"], ["One", "Two"]) if n < 4 else ([], [])
            want[url] = "\n".join([f"Title {i}", *first, *own, *last, f"part {i % 2}"])
    got = html_style_tree.extract_text(spark.createDataFrame(rows, "url string, html string")).collect()
    assert {r["url"]: r["main_text"] for r in got} == want


# ---- pipeline -------------------------------------------------------------

def test_pipeline_against_its_stages_by_brute_force(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = cp.run(spark, sf)
    assert out.columns == [*docs.columns, "token_ids", "n_tokens"]
    rows = out.collect()
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(catalog.vocabulary())
    for r in rows[:100]:
        assert r["token_ids"] == lib.encode(r["text"], add_special_tokens=False).ids and r["n_tokens"] == len(r["token_ids"])
    a = cp.language(spark, docs, sf)
    b = cp.quality(spark, a, sf)
    assert a.columns == b.columns == docs.columns
    kept = b.collect()
    prints = [naive_print(r["text"]) for r in kept]
    least = naive_components([r["doc_id"] for r in kept], prints)
    assert sorted(r["doc_id"] for r in rows) == sorted({c for c in least})
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    stay = {r["doc_id"] for r in kept}
    good = [d["doc_id"] for d in docs.collect() if labels.get(d["doc_id"]) == 1 and len((d["text"] or "").split()) >= 10]
    assert sum(d in stay for d in good) >= 0.97 * len(good)


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline as cp

    text = " ".join(f"word{i} and some" for i in range(40))
    odd = spark.createDataFrame([(1, None, None, None, None), (None, text, "en", None, 5), (2, "", "en", "s", 0), (3, text, "en", "s", 9),
                                 (3, text, "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    odd = odd.withColumns({"odd.name": F.lit(1), "fp": F.lit("x"), "n_tokens_": F.lit(None).cast("string")})  # more columns, clashing or odd names
    for name, stage in cp.STAGES:
        for df in (odd, odd.limit(0)):
            got = stage(spark, df, SF)
            assert got.columns[:len(odd.columns)] == odd.columns
            got.collect()
    assert sorted(r["doc_id"] or 0 for r in cp.dedup(spark, odd, SF).collect()) == [1, 3]
    own = ["__fp", "__root", "__language", "__quality", "__mix", "__stats", "__s", "__Slot", "__b", "mix", "mix_position", "N_tokens", "token_ids"]
    clash = odd.drop("odd.name", "fp", "n_tokens_").withColumns({c: F.lit(f"own {c}") for c in own})
    for name, stage in cp.STAGES:
        for df in (clash, clash.limit(0)):
            got = stage(spark, df, SF)
            kept = [c for c in clash.columns if name != "encode" or c.lower() not in cp.ENCODED]
            assert got.columns[:len(kept)] == kept
            assert all(r[c] == f"own {c}" for r in got.collect() for c in own if c in kept)


def test_pipeline_rows_follow_the_mixture(spark):
    import corpus_pipeline as cp

    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # files are read in many splits, the largest first
    try:
        rows = cp.run(spark, "/root/testdata/sf0.01").select("doc_id", "source").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)
    blocks = Counter(s for _, s in rows)
    blocks = {s: -(-n // 8) for s, n in blocks.items()}
    weights = {s: cp.TARGET_WEIGHTS[s] for s in blocks}
    # slots before a source's last block, which may be short: blocks of 8 rows each, every source within one block of its target
    slots = int(min((blocks[s] - 1) / (w / sum(weights.values())) for s, w in weights.items()))
    assert slots > 15
    had = Counter()
    for t in range(1, slots + 1):
        block = {s for _, s in rows[8 * t - 8:8 * t]}
        assert len(block) == 1
        had.update(block)
        assert all(abs(had[s] - w / sum(weights.values()) * t) < 1 for s, w in weights.items())


def test_encode_finds_the_position_again(spark):
    import corpus_pipeline as cp

    docs = spark.createDataFrame([(i, f"text {i}", "en", "src0" if i % 3 else "src1", 6) for i in range(900)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    want = {r["doc_id"]: r["mix"]["position"] for r in cp.pfair_mix.pfair_mix(docs, cp.TARGET_WEIGHTS).collect()}
    got = cp.encode(spark, cp.mix(spark, docs, SF).orderBy(F.rand(1)), SF).collect()
    assert {r["doc_id"]: r["mix_position"] for r in got} == want
    assert [r["mix_position"] for r in got] == sorted(want.values())


def test_encode_follows_the_mix_stage(spark, tmp_path):
    import corpus_pipeline as cp

    docs = spark.createDataFrame([(i, f"text {i}", "en", "src0" if i % 3 else "src1", 6, "own") for i in range(90)],
                                 "doc_id long, text string, lang string, source string, n_chars long, mix_position string")
    mixed = cp.mix(spark, docs, SF)
    assert mixed.columns[:-1] == docs.columns
    place = mixed.columns[-1]
    other = mixed.withColumn(place, (1000 - F.col(place)).alias(place, metadata=mixed.schema[place].metadata))
    other.write.parquet(str(tmp_path / "mix"))  # as between two stages
    want = {r["doc_id"]: r[place] for r in other.collect()}
    got = cp.encode(spark, spark.read.parquet(str(tmp_path / "mix")), SF).collect()
    assert {r["doc_id"]: r["mix_position"] for r in got} == want
    assert [r["mix_position"] for r in got] == sorted(want.values())
    assert all(r["mix_position"] is None for r in cp.encode(spark, docs, SF).collect())  # not mixed: no place
