"""The ``opN_*`` queries: each operator over its whole table, with its digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagic.llm import (
    bpe_automaton, bpe_replay, decision_list, external_shuffle, html_style_tree, langid, maxent_lm, merkle_manifest, nra_search, pfair_mix,
    segment_topk, simhash_gph, url_glob,
)
from pelagic.llm.common import crc_mod, lower_ascii, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def vocabulary() -> str:
    """The production vocabulary file (a parameter of the operator)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_bpe_automaton")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = docs.select("doc_id", bpe_automaton.encode_columns(spark, F.col("text"), vocabulary()).alias("__e"))
    return out.select("doc_id", "__e.n_tokens", "__e.ids_sha256", "__e.decoded_sha256")


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.train(docs.filter(crc_mod(F.col("doc_id"), 4) != 2))
    out = docs.select("doc_id", held_out.alias("held_out"), langid.predict_columns(docs, model, F.col("text")).alias("__p"))
    return out.select("doc_id", "held_out", "__p.lang_pred", "__p.score")


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = decision_list.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    out = decision_list.judge(docs, rules, into="__q")
    return out.select("doc_id", *[f"__q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@query("op4_pfair_mix")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair_mix.pfair_mix(docs).select("doc_id", "source", "mix.*")


OP7_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND coalesce(list_bool_and([coalesce(isfinite(CAST(x AS DOUBLE)), false) FOR x IN embedding]), true)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op7_segment_topk", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return segment_topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@query("op8_simhash_gph")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash_gph.components(docs)
    return out.select("doc_id", simhash_gph.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


# Fixed values of the contract.
SITE_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# The operator's own list of hosts to block, where no site rule fits.
HOST_GLOBS = ("*spam*", "*cheap-pills*", "*casino*", "xxx.*", "*.xxx", "ads.*")

OP9_SQL = """
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN host LIKE '%spam%' OR host LIKE '%cheap-pills%' OR host LIKE '%casino%' OR host LIKE 'xxx.%' OR host LIKE '%.xxx'
      OR host LIKE 'ads.%' THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


@query("op9_url_glob", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = [*[url_glob.site_rule(s, v) for s, v in SITE_RULES], *[url_glob.host_glob(g, "block") for g in HOST_GLOBS]]
    out = url_glob.judge_urls(pages, rules)
    named = F.col("url_filter.rule").isin([s for s, _ in SITE_RULES])
    return out.select("page_id", "url_filter.host", "url_filter.path", F.when(named, F.col("url_filter.rule")).alias("rule"),
                      "url_filter.verdict")


@query("op10_external_shuffle")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shards = 40
    out = external_shuffle.external_shuffle(docs, shards)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", external_shuffle.record_bytes(F.col("text")).alias("size"), F.crc32(text).alias("text_crc32"),
                      F.lit(external_shuffle.LAW).alias("law"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"),
                      external_shuffle.shard_of(F.col("doc_id").cast("string"), shards + 1, external_shuffle.SEED).alias("grown_shard"))


@query("op1_site_style_tree")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = html_style_tree.extract_text(pages, into="text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_maxent_lm")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = crc_mod(F.col("doc_id"), 5)
    model, counts = maxent_lm.train(docs.filter(fold != 1))
    held_out = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return maxent_lm.score_texts(docs, model, counts).select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def byte_ranks() -> str:
    """The production rank file of the byte-level encoder (a parameter of the operator)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op11_bpe_replay")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = docs.select("doc_id", bpe_replay.digest_column(spark, F.col("text"), byte_ranks(), split_pattern()).alias("__e"))
    return out.select("doc_id", "__e.n_tokens", "__e.ids_sha256", "__e.decoded_sha256")


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
m AS (SELECT doc_id, 100 - 25 + ((25 * len(t) * n_docs) // n_terms) AS m FROM d, c WHERE len(t) > 0),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


@query("op12_nra_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return nra_search.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), 20)


def _tree_sql(t: str, levels: int) -> str:
    """CTEs ``<t>_f<levels>`` (folds and proofs) and ``<t>_n<levels>`` (tops) over ``_f0`` (k, i, own, proof) and ``_n0`` (k, i, d)."""
    before, after = "array_to_string(kids[1:(i % 8)], '')", "array_to_string(kids[(i % 8 + 2):], '')"
    return ",\n".join(f"""{t}_r{j} AS (
  SELECT k, i // 8 AS p, list(d ORDER BY i) AS kids, any_value(c) AS c FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM {t}_n{j}) GROUP BY 1, 2),
{t}_n{j + 1} AS (SELECT k, p AS i, CASE WHEN c > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS d FROM {t}_r{j}),
{t}_f{j + 1} AS (
  SELECT x.* EXCLUDE (kids, c, i, own, proof), i // 8 AS i, CASE WHEN c > 1 THEN sha256({before} || own || {after}) ELSE own END AS own,
         proof || {before} || {after} AS proof
  FROM (SELECT f.*, r.kids, r.c FROM {t}_f{j} f JOIN {t}_r{j} r ON r.k = f.k AND r.p = f.i // 8) x)""" for j in range(levels))


_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD + ")"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Levels of the SQL: 8 to the power of 8 documents of a language, of 4 languages.
OP13_SQL = f"""
WITH RECURSIVE poly(b, v, n) AS (
  SELECT b, b, 0 FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM poly WHERE n < 8),
tab AS (SELECT list(v ORDER BY b) AS tab FROM poly WHERE n = 8),
leaves AS (SELECT doc_id, {_LEAF.format('text')} AS leaf, {_LEAF.format(_LOWER)} AS low,
  list_reduce([4294967295] || [ascii(s) FOR s IN string_split(CAST(doc_id AS VARCHAR), '')],
    lambda x, y: xor(x >> 8, tab[(xor(x, y) & 255) + 1])) AS crc,
  dense_rank() OVER (ORDER BY lang IS NOT NULL, lang) - 1 AS k,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS i FROM documents, tab),
a_f0 AS (SELECT doc_id, leaf, k, i, CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN low ELSE leaf END AS own, '' AS proof FROM leaves),
a_n0 AS (SELECT k, i, leaf AS d FROM leaves),
{_tree_sql("a", 8)},
b_f0 AS (SELECT f.doc_id, f.leaf, n.d AS subroot, 0 AS k, f.k AS i, f.own, f.proof FROM a_f8 f JOIN a_n8 n ON n.k = f.k),
b_n0 AS (SELECT 0 AS k, k AS i, d FROM a_n8),
{_tree_sql("b", 4)}
SELECT f.doc_id, f.leaf, f.subroot, n.d AS root, sha256(f.proof) AS proof_sha256, f.own AS folded_root, f.own = n.d AS verified
FROM b_f4 f, b_n4 n
"""


@query("op13_merkle_intervals", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = merkle_manifest.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], lower_ascii(F.col("text")))
    claim = F.when(crc_mod(F.col("doc_id"), 3) == 0, tampered)
    m = merkle_manifest.manifest(docs, docs.columns, "lang", "doc_id", {"claim": claim})
    m = m.withColumn("folded_root", merkle_manifest.fold(F.coalesce("claim", "leaf"), F.col("path")))
    return m.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle_manifest.proof_digests(F.col("path")), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
