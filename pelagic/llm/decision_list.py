"""Quality rules: decision lists learned from labelled text statistics.

``text_stats`` computes each text's statistics.  ``learn`` fits an ordered list
of reject rules by sequential covering: grow a conjunction of thresholds on two
thirds of the rows still uncovered (best information gain first), prune its
tail on the other third, keep it if it is precise enough there, drop the rows
it covers, repeat.  ``DecisionList.verdict`` is the ordered Spark conditional
expression; ``str()`` shows the rules.

Labelled rows: a hash sample of at most ``max_labelled`` (documented bound); a
document labelled twice counts as its worst label, a null label not at all.
Without labels of both kinds the list is empty and the verdict is "keep".

Null text: no words, all statistics 0.  Texts are read whole.  Equal rows give
equal results; extra columns of any name pass through untouched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.llm.common import WORD, checkpointed, fresh, text_batches

WORDS = re.compile(WORD)
# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_distinct_words long, n_upper long"
STAT_NAMES = [x.split()[0] for x in STATS.split(", ")]


def repeated_positions(ids: np.ndarray, window: int = WINDOW) -> int:
    """Positions inside a ``window`` of ids that occurs at least twice."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    size = int(ids.max()) + 1
    if size ** window < 1 << 62:
        code = np.zeros(n, dtype=np.int64)
        for k in range(window):
            code = code * size + ids[k:k + n]
    else:  # rank the codes of shorter windows first, so a code always fits
        code = ids[:n].astype(np.int64)
        for k in range(1, window):
            code = np.unique(code * size + ids[k:k + n], return_inverse=True)[1].astype(np.int64)
    order = np.argsort(code, kind="stable")
    s = code[order]
    same = s[1:] == s[:-1]
    hit = np.zeros(n, dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    if not hit.any():
        return 0
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    cover[:n] += hit
    cover[window:window + n] -= hit
    return int((np.cumsum(cover) > 0).sum())


def stats_of(text: str | None) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``STAT_NAMES``."""
    if not text:
        return (0,) * len(STAT_NAMES)
    words = WORDS.findall(text)
    at: dict[str, int] = {}
    ids = np.fromiter((at.setdefault(w, len(at)) for w in words), dtype=np.int64, count=len(words))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif WORDS.search(line):
            seen.add(line)
    upper = sum(text.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in SYMBOLS), dup,
            repeated_positions(ids), len(at), upper)


def stats_column(docs: DataFrame, text: Column) -> Column:
    """Struct of the statistics of whole texts."""
    text_batches(docs.sparkSession)

    @F.pandas_udf(STATS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([stats_of(t) for t in texts], columns=STAT_NAMES)

    return run.asNondeterministic()(text)


def ratios(s: str) -> dict[str, Column]:
    """Features the rules may test, from the statistics struct column ``s``."""
    def per(a: str, b: str) -> Column:
        return F.col(f"{s}.{a}") / F.greatest(F.col(f"{s}.{b}"), F.lit(1))

    return {
        "words": F.col(f"{s}.n_words").cast("double"),
        "chars_per_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "distinct_share": per("n_distinct_words", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
        "dup_lines": F.col(f"{s}.n_dup_lines").cast("double"),
    }


def base_failed(s: str) -> Column:
    """The fixed base rule: too short, or over a fifth of the words in repeated windows."""
    return (F.col(f"{s}.n_words") < 10) | (100 * F.col(f"{s}.n_repeat_words") > 20 * F.col(f"{s}.n_words"))


@dataclass
class Rule:
    """All of ``tests`` (feature, ``>`` or ``<=``, threshold) hold."""

    tests: list[tuple[str, str, float]]
    covered: int = 0
    correct: int = 0

    def column(self, features: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, op, x in self.tests:
            out = out & ((features[name] > F.lit(x)) if op == ">" else (features[name] <= F.lit(x)))
        return out

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for name, op, t in self.tests:
            out &= (x[name] > t) if op == ">" else (x[name] <= t)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {o} {t:.6g}" for n, o, t in self.tests)


@dataclass
class DecisionList:
    """Ordered reject rules; a text that none of them covers is kept."""

    rules: list[Rule] = field(default_factory=list)

    def verdict(self, features: dict[str, Column]) -> Column:
        """``CASE WHEN rule1 THEN false WHEN rule2 THEN false ... ELSE true END``."""
        out = None
        for r in self.rules:
            c = r.column(features)
            out = F.when(c, F.lit(False)) if out is None else out.when(c, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def keeps(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for r in self.rules:
            out &= ~r.mask(x)
        return out

    def __str__(self) -> str:
        return "".join(f"reject if {r}\n" for r in self.rules) + "else keep"


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        g = p * (np.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
    return np.where(p > 0, g, -np.inf)


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], max_tests: int) -> Rule:
    rule, at = Rule([]), np.ones(len(bad), dtype=bool)
    while len(rule.tests) < max_tests:
        p0, n0 = int((at & bad).sum()), int((at & ~bad).sum())
        if not p0 or not n0:
            break
        best = (0.0, None)
        for name, cut in cuts.items():
            v = x[name][at]
            b = bad[at]
            pos, neg = np.sort(v[b]), np.sort(v[~b])
            p_le, n_le = np.searchsorted(pos, cut, "right"), np.searchsorted(neg, cut, "right")
            for op, p, n in (("<=", p_le, n_le), (">", p0 - p_le, n0 - n_le)):
                g = _gain(p.astype(float), n.astype(float), p0, n0)
                k = int(np.argmax(g))
                if g[k] > best[0] + 1e-9:
                    best = (float(g[k]), (name, op, float(cut[k])))
        if best[1] is None:
            break
        rule.tests.append(best[1])
        at &= Rule([best[1]]).mask(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The head of the rule with the best (bad - good) / covered on the pruning rows."""
    best, kept = -2.0, rule
    for k in range(len(rule.tests), 0, -1):
        r = Rule(rule.tests[:k])
        m = r.mask(x)
        if m.any():
            w = float((m & bad).sum() - (m & ~bad).sum()) / float(m.sum())
            if w >= best:
                best, kept = w, r
    m = kept.mask(x)
    kept.covered, kept.correct = int(m.sum()), int((m & bad).sum())
    return kept


def cover(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray, *, max_rules: int = 16, max_tests: int = 4,
          max_cuts: int = 200, min_precision: float = 0.95, min_covered: int = 3) -> DecisionList:
    """Sequential covering of the ``bad`` rows; ``fold`` 0 and 1 grow a rule, 2 prunes it."""
    out = DecisionList()
    left = np.ones(len(bad), dtype=bool)
    cuts = {}
    for name, v in x.items():
        u = np.unique(v)
        if len(u) > max_cuts:  # thresholds between quantiles of both classes
            q = np.linspace(0, 1, max_cuts // 2)
            u = np.unique(np.concatenate([np.quantile(v[m], q) for m in (bad, ~bad) if m.any()]))
        cuts[name] = (u[:-1] + u[1:]) / 2 if len(u) > 1 else u
    for _ in range(max_rules):
        grow, prune = left & (fold != 2), left & (fold == 2)
        if not (grow & bad).any() or not (grow & ~bad).any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], cuts, max_tests)
        if not rule.tests:
            break
        rule = _prune(rule, {k: v[prune] for k, v in x.items()}, bad[prune])
        if rule.covered < min_covered or rule.correct < min_precision * rule.covered:
            break
        out.rules.append(rule)
        left &= ~rule.mask(x)
    return out


def labelled_sample(labels: DataFrame, id_col: str, label: str, max_labelled: int) -> DataFrame:
    """At most ``max_labelled`` labelled ids (``__id``, ``__bad``), chosen by a hash of the id."""
    one = (labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("__id")).agg(F.min(label).alias("__label")))
    return (one.select("__id", (F.col("__label") == 0).alias("__bad"))
            .orderBy(F.xxhash64(F.lit(6), F.col("__id").cast("string")), "__id").limit(max_labelled))


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          max_labelled: int = 12_000, **grow) -> DecisionList:
    """Learn the list from the labelled rows among ``docs`` (label 0: reject)."""
    sample = checkpointed(labelled_sample(labels, id_col, label, max_labelled))
    # the sample's size is bounded by max_labelled, so it may be broadcast
    found = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(sample), "__id")
    rows = found.select("__id", "__bad", stats_column(docs, F.col("__text")).alias("__s"))
    names = list(ratios("__s"))
    got = (rows.select("__id", "__bad", *[c.alias(n) for n, c in ratios("__s").items()])
           .groupBy("__id").agg(F.first("__bad").alias("__bad"), *[F.max(n).alias(n) for n in names]))
    pdf = got.select("__bad", F.pmod(F.crc32(F.col("__id").cast("string")), F.lit(3)).alias("__fold"), *names).toPandas()
    if not len(pdf):
        return DecisionList()
    return cover({n: pdf[n].to_numpy(dtype=float) for n in names}, pdf["__bad"].to_numpy(dtype=bool),
                 pdf["__fold"].to_numpy(dtype=int), **grow)


def judge(docs: DataFrame, rules: DecisionList, text: str = "text", into: str = "quality_rules") -> DataFrame:
    """``docs`` with the struct ``into``: the statistics, ``base_failed`` and ``kept``."""
    (stats,) = fresh(docs, "__stats")
    s = docs.withColumn(stats, stats_column(docs, F.col(text)))
    kept = ~base_failed(stats) & rules.verdict(ratios(stats))
    return s.withColumn(into, F.struct(f"{stats}.*", base_failed(stats).alias("base_failed"), kept.alias("kept"))).drop(stats)
