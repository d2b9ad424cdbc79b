"""Language identification by word-first backoff.

Training counts words per language, in Spark, over a bounded sample of labelled
documents (``docs_per_lang`` of each language, drawn by a hash of the id).  The
model keeps the ``max_words`` commonest words of each language and, for each
order n, its ``max_grams`` commonest character n-grams (words padded with one
space at either end, which is no n-gram by itself).  Its size is bounded by those parameters.

Scoring: a word that any language knows costs each language -log10 of the
word's share there (a fixed penalty where it is unknown).  A word that no
language knows falls back to its n-grams of the longest order of which any
language knows one, then to shorter ones; it costs the mean over the known
n-grams.  A word without any known n-gram says nothing.  A document's cost is
the mean over its words; the cheapest language wins, ties go to the smaller name.
Only the languages that know an entry are held with it, so any number of labels
can be learned; ``max_entries`` shares the model's room among many of them.

``score`` is the softmax of minus the cost per word times ln 10 times the
number of words that say something, at most ``evidence`` of them: 1 / languages
if no word says anything, near 1 for clear texts.

Null text, or text without a letter (a character of Unicode category L; number
signs are none): ``und`` with score 0, also if there is nothing to learn from.
An empty table gives no rows.  Texts are read whole, of any length.  Null ids are neither held out
nor learned from.  Equal rows give equal results; extra columns pass untouched.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagic.llm.common import BoundedCache, checkpointed, small_broadcast, text_batches, worker_cache

WORD_CHARACTERS = re.compile(r"[^\W\d_]+")  # letters, and number signs such as a half
HELD_GRAMS = 1 << 17  # n-grams of unseen words summed at a time
ORDERS = (6, 5, 4, 3, 2, 1)
UNDETERMINED = "und"
CACHED_WORDS = 100_000
FEW_LANGUAGES = 100_000  # so many small rows are broadcast
MISSING = object()


def letter_runs(text: str) -> Counter:
    """How often each run of letters is in the lower-cased text."""
    counts = Counter(WORD_CHARACTERS.findall(text.lower()))
    for w in [w for w in counts if not w.isalpha()]:
        c = counts.pop(w)
        for run in "".join(x if x.isalpha() else " " for x in w).split():
            counts[run] += c
    return counts


@dataclass
class Costs:
    """Per entry (word or n-gram) the languages that know it and what that saves them of the fixed penalty."""

    at: dict[str, int] = field(default_factory=dict)
    start: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))
    lang: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    saved: np.ndarray = field(default_factory=lambda: np.zeros(0))
    penalty: float = 0.0

    @classmethod
    def of(cls, rows: list[tuple[str, int, float]]) -> "Costs":
        """From (entry, number of the language, share there)."""
        rows = sorted(rows)
        at = {g: i for i, g in enumerate(dict.fromkeys(r[0] for r in rows))}
        share = np.array([r[2] for r in rows], dtype=float)
        penalty = 1.0 - math.log10(share.min()) if len(rows) else 0.0
        known = np.bincount([at[r[0]] for r in rows], minlength=len(at)) if rows else np.zeros(0, dtype=np.int64)
        return cls(at, np.r_[0, np.cumsum(known)], np.array([r[1] for r in rows], dtype=np.int32), np.log10(share) + penalty, penalty)

    def total(self, entries: list[int], times: list[int], langs: int) -> np.ndarray:
        """Cost of the entries to each language, each so many times."""
        entries, times = np.asarray(entries), np.asarray(times, dtype=float)
        first, known = self.start[entries], self.start[entries + 1] - self.start[entries]
        where = np.arange(known.sum()) + np.repeat(first - (np.cumsum(known) - known), known)
        saved = np.bincount(self.lang[where], weights=self.saved[where] * np.repeat(times, known), minlength=langs)
        return self.penalty * times.sum() - saved


@dataclass
class Model:
    """Languages, sorted, and the costs of words and of n-grams."""

    langs: list[str]
    words: Costs = field(default_factory=Costs)
    grams: Costs = field(default_factory=Costs)

    def unseen(self, word: str) -> list[int]:
        """The longest known n-grams of a word no language knows."""
        padded, grams = f" {word} ", self.grams.at
        for n in ORDERS:
            at = [g for i in range(len(padded) - n + 1) if (g := grams.get(padded[i:i + n])) is not None]
            if at:
                return at
        return []

    def predict(self, text: str | None, cache: BoundedCache, evidence: int) -> tuple[str, float]:
        counts = letter_runs(text) if text else None
        if not counts or not self.langs:
            return UNDETERMINED, 0.0
        langs, n = len(self.langs), 0
        total = np.zeros(langs)
        known, times, parts, shares = [], [], [], []
        words = self.words.at
        for w, c in counts.items():
            k = words.get(w)
            if k is not None:
                known.append(k)
                times.append(c)
                n += c
                continue
            at = cache.get(w, MISSING)
            if at is MISSING:
                at = cache.recall(w, MISSING)
                if at is MISSING:
                    at = cache[w] = self.unseen(w)
            if at:
                parts += at
                shares += [c / len(at)] * len(at)
                n += c
                if len(parts) >= HELD_GRAMS:
                    total += self.grams.total(parts, shares, langs)
                    parts, shares = [], []
        if known:
            total += self.words.total(known, times, langs)
        if parts:
            total += self.grams.total(parts, shares, langs)
        mean = total / max(n, 1)
        best = int(np.argmin(mean))  # the first of equals; languages are sorted
        odds = np.exp(-(mean - mean[best]) * math.log(10) * min(n, evidence))
        return self.langs[best], float(1 / odds.sum())


def sample_labelled(docs: DataFrame, lang: str, id_col: str, docs_per_lang: int) -> DataFrame:
    """About ``docs_per_lang`` documents of each language, by a hash of the id."""
    langs = docs.select(F.count_distinct(lang)).first()[0]
    share = (docs.filter(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("__l")).agg(F.count("*").alias("__n"))
             .select("__l", (F.lit(float(docs_per_lang)) / F.col("__n")).alias("__share")))
    draw = F.pmod(F.xxhash64(F.lit(11), F.col(id_col).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return docs.join(small_broadcast(share, langs, FEW_LANGUAGES), F.col(lang) == F.col("__l")).filter(draw < F.col("__share"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", *,
          docs_per_lang: int = 3000, max_words: int = 20_000, max_grams: int = 5_000,
          max_entries: int = 5_000_000) -> Model:
    """Fit the model on labelled ``docs``; many languages share ``max_entries``, in the proportion of the other bounds."""
    labelled = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"), F.col(lang).alias("__lang"))
    sample = sample_labelled(labelled, "__lang", "__id", docs_per_lang)
    word = F.explode(F.regexp_extract_all(F.lower("__text"), F.lit(r"\p{L}+"), 0))
    words = checkpointed(sample.select(F.col("__lang").alias("l"), word.alias("w")).groupBy("l", "w").agg(F.count("*").alias("c")))
    padded = F.concat(F.lit(" "), "w", F.lit(" "))

    def pieces(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n)))

    grams = words.select("l", "c", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), pieces(n).alias("g")) for n in ORDERS])).alias("x"))
    grams = (grams.select("l", "c", "x.n", F.explode("x.g").alias("g")).filter((F.length("g") == F.col("n")) & (F.col("g") != " "))
             .groupBy("l", "n", "g").agg(F.sum("c").alias("c")))
    langs = sorted(r[0] for r in words.select("l").distinct().collect())
    share = min(1.0, max_entries / max(1, len(langs) * (max_words + len(ORDERS) * max_grams)))
    return Model(langs, _costs(words.withColumn("n", F.lit(0)).withColumnRenamed("w", "g"), langs, max(1, int(share * max_words))),
                 _costs(grams, langs, max(1, int(share * max_grams))))


def _costs(counts: DataFrame, langs: list[str], keep: int) -> Costs:
    """The ``keep`` commonest entries of each (language, order) with their share of all its entries."""
    total = counts.groupBy("l", "n").agg(F.sum("c").alias("t"))
    top = (counts.withColumn("k", F.row_number().over(W.partitionBy("l", "n").orderBy(F.desc("c"), "g")))
           .filter(F.col("k") <= keep))
    total = small_broadcast(total, len(langs) * len(ORDERS), FEW_LANGUAGES)
    rows = top.join(total, ["l", "n"]).select("l", "g", (F.col("c") / F.col("t")).alias("p")).collect()
    number = {x: i for i, x in enumerate(langs)}
    return Costs.of([(r["g"], number[r["l"]], r["p"]) for r in rows])


def predict_columns(docs: DataFrame, model: Model, text: Column, evidence: int = 20) -> Column:
    """Struct (lang_pred, score) of whole texts."""
    spark = docs.sparkSession
    text_batches(spark)
    shared, name = spark.sparkContext.broadcast(model), f"langid:{uuid.uuid4()}"

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m, cache = shared.value, worker_cache(name, CACHED_WORDS)
        for texts in batches:
            yield pd.DataFrame([m.predict(t, cache, evidence) for t in texts], columns=["lang_pred", "score"])

    return run.asNondeterministic()(text)


def predict_language(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with the struct column ``into`` (lang_pred, score)."""
    return docs.withColumn(into, predict_columns(docs, model, F.col(text)))
