"""LM scoring by a hashed maximum-entropy model.

Tokens: words of the A-Z-lower-cased text, then one end token.  Token counts c
come from all training texts (N tokens, V distinct).  Tokens are known in two
exact ways: the commonest ``head`` (bounded) is looked up in the tasks, every
other token by a shuffle join with the counts.

The model factors a token into a chain of choices, the places on its path in a
tree of ``class_size`` children a node:

    P(w | h) = product of P(place | node, h) over the nodes of w's path

The tree is the Huffman tree of the counts.  Its leaves are the ``model_words``
commonest tokens (all of the head) and the classes of all others, by the hash of
their last three characters; there are more classes the more distinct tokens.
Inside a class P(w) = (c + 0.5) / (N' + 0.5 (V' + 1)) over its N' tokens, V'
distinct, and one place for the unseen.  Each choice is a softmax, linear in
hashed n-gram features (previous word, previous two) and skip features (the word
before the previous, the one before that), started from the token counts.

Training: in each round every partition runs minibatch gradient steps over its
share of all training texts, from the weights of the round before; the changes,
weighted by tokens, are summed over partitions in Spark, block by block of the
weight vector.  The driver holds one weight vector, of fixed size.  Scoring
runs the same sparse numpy batches over every text.

Null text counts as empty (its end token is scored).  Null ids are neither held
out nor learned from.  Texts are read whole, in windows.  Repeated rows are
scored apart.  Rows are numbered by input partition: give it a stable input
(a table, or a checkpoint).
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagic.llm.common import checkpointed, text_batches

END = "\n"  # no word holds white space
WINDOW = 1 << 16  # tokens of one gradient step
BATCH = 1 << 13  # tokens of one numpy batch: its arrays stay in the processor's cache
LARGEST = 80.0  # logits above are taken for it, so their powers fit 32-bit floats
BLOCKS = 32  # pieces of the weight vector
SUFFIX_CODES = 1 << 16  # at most so many classes of rare tokens
DAMPING = 64.0  # keeps rare features from learning their few tokens by heart
MIX = np.uint64(0x9E3779B97F4A7C15)


def split_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, A-Z lower-cased, and the text each belongs to (end tokens are left to the caller)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    some = pc.not_equal(words, "")
    if pc.all(some).as_py() is False:
        words, owner = words.filter(some), owner[some.to_numpy(zero_copy_only=False)]
    return words, owner


def token_counts(docs: DataFrame, text: str) -> DataFrame:
    """(token, c) over all texts; batches and tasks count ahead of the shuffle."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                seen = pc.value_counts(split_tokens(b.column(0))[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([seen.field("values"), pa.array([END])]),
                     pa.concat_arrays([seen.field("counts"), pa.array([b.num_rows], pa.int64())])], names=["token", "c"])

    return (docs.select(F.col(text).alias("text")).mapInArrow(run, "token string, c long")
            .groupBy("token").agg(F.sum("c").alias("c")))


@dataclass
class Shape:
    """Sizes of the model; all bounded parameters."""

    head: int = 100_000
    model_words: int | None = None  # None: the whole head
    class_size: int = 8
    bits: int = 17
    suffix_codes: int = 4096


def huffman(mass: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes and places on each leaf's path from the leaf up (-1 past the root), and the mass of each node's children."""
    leaves = len(mass)
    nodes = max(1, -(-(leaves - 1) // (size - 1)))
    full = nodes * (size - 1) + 1  # places without a leaf have no mass and can't occur
    heap = [(0.0, i) for i in range(leaves, full)] + [(float(x), i) for i, x in enumerate(mass)]
    heapq.heapify(heap)
    up, place = np.full(full + nodes, -1), np.zeros(full + nodes, dtype=np.int64)
    below = np.zeros((nodes, size))
    for k in range(nodes):
        for a in range(size):
            below[k, a], child = heapq.heappop(heap)
            up[child], place[child] = k, a
        heapq.heappush(heap, (below[k].sum(), full + k))
    at, path, places = np.arange(leaves), [], []
    while (up[at] >= 0).any():
        path.append(up[at])
        places.append(place[at])
        at = np.where(up[at] >= 0, full + up[at], at)
    return np.stack(path, axis=1).astype(np.int32), np.stack(places, axis=1).astype(np.int16), below


class MaxEnt:
    """Vocabulary, tree, start values and weights."""

    def __init__(self, head: list[tuple[str, int]], n: int, v: int, shape: Shape, tail: dict[int, tuple[int, int]] | None = None):
        """``tail``: tokens and distinct tokens outside the head by suffix code; None: all tokens without a leaf are one class."""
        head = sorted(head, key=lambda x: (-x[1], x[0]))
        self.shape, self.n, self.v = shape, n, v
        self.vocab = pa.array([w for w, _ in head], pa.string())
        self.end = next((i for i, (w, _) in enumerate(head) if w == END), None)
        self.start = len(head) + shape.suffix_codes  # the code before a text
        c = np.array([x for _, x in head], dtype=float)
        m = self.model_words = len(head) if shape.model_words is None else min(shape.model_words, len(head))
        self.base_log = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        self.rest_n, self.rest_v = n - float(c[:m].sum()), v - m
        # the class of each code (0 for codes with a leaf), and tokens and distinct tokens of each class
        kind = np.zeros(len(head) + shape.suffix_codes, dtype=np.int64)
        if tail is None:
            class_n, class_v = np.array([self.rest_n]), np.array([float(self.rest_v)])
        else:
            kind[len(head):] = np.arange(shape.suffix_codes)
            kind[m:len(head)] = [self.suffix(w[-3:]) for w, _ in head[m:]]
            class_n, class_v = np.zeros(shape.suffix_codes), np.zeros(shape.suffix_codes)
            for k, (tokens, distinct) in tail.items():
                class_n[k], class_v[k] = tokens, distinct
            class_n += np.bincount(kind[m:len(head)], weights=c[m:], minlength=len(class_n))
            class_v += np.bincount(kind[m:len(head)], minlength=len(class_v))
        self.class_total = class_n + 0.5 * (class_v + 1)
        self.kind = kind
        self.rest_log = np.log10((c + 0.5) / self.class_total[kind[:len(head)]])
        self.leaf = np.where(np.arange(len(kind)) < m, np.arange(len(kind)), m + kind)
        self.path, self.place, below = huffman(np.r_[c[:m] + 0.5, class_n + 0.5], shape.class_size)
        with np.errstate(divide="ignore"):
            log_mass = np.log(below) - np.log(below.sum(axis=1, keepdims=True))
        self.bias = np.where(below > 0, log_mass, -30.0).astype(np.float32)
        self.weights = np.zeros(shape.class_size << shape.bits, dtype=np.float32)
        self.node_hash = self.hashed(5, 64, np.arange(len(self.bias)))

    def table(self, weights: np.ndarray) -> np.ndarray:
        return weights.reshape(-1, self.shape.class_size)

    def code(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Table]:
        """Token codes of all texts, three start codes before each; the text of each code; (doc, token, code, times) outside the head."""
        words, owner = split_tokens(texts)
        d, h = len(texts), len(self.vocab)
        own = pc.fill_null(pc.index_in(words, value_set=self.vocab), -1).to_numpy().astype(np.int64)
        out = own < 0
        rare = words.filter(pa.array(out))
        ends = pc.utf8_slice_codeunits(rare, start=-3, stop=1 << 30).dictionary_encode()
        codes_of = np.array([h + self.suffix(x) for x in ends.dictionary.to_pylist()], dtype=np.int64)
        if len(codes_of):
            own[out] = codes_of[ends.indices.to_numpy()]
        n = np.bincount(owner, minlength=d)
        first = np.cumsum(n + 4) - (n + 4)
        codes = np.full(int((n + 4).sum()), self.start, dtype=np.int64)
        codes[np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first + 3, n)] = own
        codes[first + 3 + n] = h + self.suffix(END) if self.end is None else self.end
        rest = pa.table({"doc": owner[out], "token": rare, "code": own[out]})
        if self.end is None:
            rest = pa.concat_tables([rest, pa.table({"doc": np.arange(d), "token": pa.array([END] * d, pa.string()),
                                                    "code": np.full(d, h + self.suffix(END))})])
        rest = rest.group_by(["doc", "token", "code"]).aggregate([([], "count_all")])
        return codes, np.repeat(np.arange(d), n + 4), rest

    def suffix(self, ending: str) -> int:
        return zlib.crc32(ending.encode("utf-8", "surrogatepass")) % self.shape.suffix_codes

    @staticmethod
    def hashed(salt: int, bits: int, *parts: np.ndarray) -> np.ndarray:
        h = np.full(len(parts[0]), salt + 1, dtype=np.uint64) * MIX
        for p in parts:
            h = (h ^ p.astype(np.uint64)) * MIX
            h ^= h >> np.uint64(29)
        h = (h * MIX) >> np.uint64(64 - bits)
        return h if bits == 64 else h.astype(np.int64)

    def choices(self, codes: np.ndarray, p: np.ndarray) -> Iterator[tuple]:
        """(which of the positions ``p``, features, node, place) of each step up the paths."""
        leaf, own, shift = self.leaf[codes[p]], np.arange(len(p)), np.uint64(64 - self.shape.bits)
        past = [self.hashed(k, 64, *(codes[p - d] for d in back)) for k, back in enumerate(((1,), (2, 1), (2,), (3,)), 1)]
        for d in range(self.path.shape[1]):
            node = self.path[:, d][leaf]
            live = node >= 0
            if not live.all():
                keep = np.flatnonzero(live)
                own, leaf, node, past = own[keep], leaf[keep], node[keep], [h[keep] for h in past]
            if not len(own):
                return
            # history and node are hashed already: one xor and one product mix them
            named = self.node_hash[node]
            feats = [(((named ^ h) * MIX) >> shift).view(np.int64) for h in past]
            yield own, feats, node, self.place[:, d][leaf]

    def powers(self, table: np.ndarray, feats: list[np.ndarray], node: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per choice: e to the logits, their sum, the logit taken, and the taken places in the flat logits."""
        z = table.take(feats[0], axis=0, mode="clip")
        for f in feats[1:]:
            z += table.take(f, axis=0, mode="clip")
        z += self.bias.take(node, axis=0)
        np.minimum(z, LARGEST, out=z)
        at = np.arange(len(z)) * z.shape[1] + place
        taken = z.ravel()[at]
        np.exp(z, out=z)
        return z, z @ np.ones(z.shape[1], dtype=np.float32), taken, at

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Natural log of the path's probability at each code (0 at start codes; without the token's share of its class)."""
        out, table, targets = np.zeros(len(codes)), self.table(self.weights), np.flatnonzero(codes != self.start)
        for lo in range(0, len(targets), BATCH):
            p = targets[lo:lo + BATCH]
            found = np.zeros(len(p))
            for own, feats, node, place in self.choices(codes, p):
                _, total, taken, _ = self.powers(table, feats, node, place)
                found[own] += taken - np.log(total)
            out[p] = found
        return out

    def step(self, weights: np.ndarray, square: np.ndarray, codes: np.ndarray, rate: float) -> int:
        """Adaptive gradient steps over the windows of ``codes``, on ``weights`` in place; tokens seen."""
        table, targets = self.table(weights), np.flatnonzero(codes != self.start)
        for first in range(0, len(targets), WINDOW):
            window, slopes, rows = targets[first:first + WINDOW], [], []
            for lo in range(0, len(window), BATCH):
                for own, feats, node, place in self.choices(codes, window[lo:lo + BATCH]):
                    g, total, _, at = self.powers(table, feats, node, place)
                    g /= total[:, None]
                    g.ravel()[at] -= 1
                    slopes.append(g)
                    rows.append(np.stack(feats))
            self._update(weights, square, np.concatenate(rows, axis=1), np.concatenate(slopes), rate)
        return len(targets)

    @staticmethod
    def _update(weights: np.ndarray, square: np.ndarray, feats: np.ndarray, g: np.ndarray, rate: float) -> None:
        width = g.shape[1]
        total = np.empty((len(weights) // width, width), dtype=np.float32)
        for place, slope in enumerate(g.T.astype(float)):  # a column at a time: no index of single weights
            total[:, place] = sum(np.bincount(f, weights=slope, minlength=len(total)) for f in feats)
        total = total.ravel()
        square += total * total
        weights -= rate * total / np.sqrt(square + DAMPING)


def block_edges(n: int) -> np.ndarray:
    return np.linspace(0, n, BLOCKS + 1).astype(np.int64)


def train(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, shape: Shape | None = None, rounds: int = 2,
          rate: float = 0.5) -> tuple[MaxEnt, DataFrame]:
    """The model, and the counts (token, c) of all training tokens."""
    shape = shape or Shape()
    spark = docs.sparkSession
    counts = checkpointed(token_counts(docs, text))
    # counts by size class (eighths of powers of two) show how far down the head may reach
    size_class = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    bins = counts.groupBy(size_class.alias("b")).agg(F.count("*").alias("k"), F.sum("c").alias("n")).collect()
    n, v = sum(r["n"] for r in bins), sum(r["k"] for r in bins)
    room, least = shape.head, None
    for r in sorted(bins, key=lambda r: -r["b"]):
        room -= r["k"]
        if room < 0:
            break
        least = r["b"]
    head = [tuple(r) for r in counts.filter(size_class >= least).select("token", "c").collect()] if least is not None else []
    # all other tokens by suffix code; the codes follow the distinct tokens
    shape = replace(shape, suffix_codes=max(shape.suffix_codes, min(SUFFIX_CODES, v // 64)))
    code = F.pmod(F.crc32(F.substring("token", -3, 3)), F.lit(shape.suffix_codes))
    outside = counts if least is None else counts.filter(size_class < least)
    tail = {r[0]: (r[1], r[2]) for r in outside.groupBy(code.alias("k")).agg(F.sum("c"), F.count("*")).collect()}
    model = MaxEnt(head, n, v, shape, tail)
    part = F.pmod(F.xxhash64(F.lit(5), F.col(id_col).cast("string")), F.lit(rounds))
    for k in range(rounds):
        model.weights = model.weights + _round(docs.filter(part == k), text, model, rate / (1 + k))
    return model, counts


def _round(docs: DataFrame, text: str, model: MaxEnt, rate: float) -> np.ndarray:
    """The change of the weights after one pass over ``docs``: the partitions' changes, weighted by their tokens."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    edges = block_edges(len(model.weights))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: MaxEnt = shared.value
        weights, square, n = m.weights.copy(), np.zeros_like(m.weights), 0
        for b in batches:
            if b.num_rows:
                n += m.step(weights, square, m.code(b.column(0))[0], rate)
        if n:
            change = (weights - m.weights) * np.float32(n)
            yield pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()), "n": pa.array([n] * BLOCKS, pa.int64()),
                                              "change": [change[a:b].tobytes() for a, b in zip(edges, edges[1:])]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list] = {}
        for pdf in batches:
            for k, n, raw in zip(pdf["block"], pdf["n"], pdf["change"]):
                x = np.frombuffer(raw, dtype=np.float32)
                had = total.setdefault(k, [0, np.zeros(len(x))])
                had[0] += n
                had[1] += x
        for k, (n, x) in total.items():
            yield pd.DataFrame({"block": [k], "n": [n], "change": [(x / n).astype(np.float32).tobytes()]})

    changes = docs.select(F.col(text).alias("text")).mapInArrow(learn, "block int, n long, change binary")
    summed = changes.repartition(BLOCKS, "block").mapInPandas(add, "block int, n long, change binary").collect()
    out = np.zeros(len(model.weights), dtype=np.float32)
    for r in summed:
        out[edges[r["block"]]:edges[r["block"] + 1]] = np.frombuffer(r["change"], dtype=np.float32)
    return out


def score_texts(docs: DataFrame, model: MaxEnt, counts: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``id_col``, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    text_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    sums = ["n_tokens", "n_known", "base", "score"]
    schema = f"row long, token string, times long, class_total double, id {kept.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, base double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: MaxEnt = shared.value
        first, h = TaskContext.get().partitionId() << 40, len(m.vocab)
        for b in batches:
            d = b.num_rows
            if not d:
                continue
            codes, owner, rest = m.code(b.column(1))
            total = m.score(codes) / math.log(10)
            in_head = codes < h
            head, whose = codes[in_head], owner[in_head]
            other = head >= m.model_words
            score = np.bincount(owner, weights=total, minlength=d).astype(float)
            score += np.bincount(whose[other], weights=m.rest_log[head[other]], minlength=d)
            row, names = first + np.arange(d), ["row", "token", "times", "class_total", "id", *sums]
            # one row with the document's sums, whose token no text holds, then one per token outside the head
            yield pa.RecordBatch.from_arrays([
                pa.array(row), pa.array([f" {r}" for r in row]), pa.array(np.zeros(d, np.int64)), pa.array(np.ones(d)), b.column(0),
                pa.array(np.bincount(owner, minlength=d) - 3), pa.array(np.bincount(whose, minlength=d)),
                pa.array(np.bincount(whose, weights=m.base_log[head], minlength=d).astype(float)), pa.array(score.astype(float))], names=names)
            k = rest.num_rows
            if k:
                yield pa.RecordBatch.from_arrays([
                    pa.array(row[rest["doc"].to_numpy()]), rest["token"].combine_chunks(), rest["count_all"].combine_chunks(),
                    pa.array(m.class_total[m.kind[rest["code"].to_numpy()]]),
                    pa.nulls(k, b.column(0).type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()),
                    pa.nulls(k, pa.float64())], names=names)
            first += d

    c = F.coalesce("c", F.lit(0))
    base_log = F.log10((c + 0.5) / F.lit(model.n + 0.5 * (model.v + 1)))
    rest_log = F.log10((c + 0.5) / F.col("class_total"))
    parts = kept.mapInArrow(run, schema).join(counts, "token", "left")
    summed = parts.groupBy("row").agg(
        F.max("id").alias(id_col), *[F.max(x).alias(x) for x in sums], F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * base_log).alias("base_rest"), F.sum(F.col("times") * rest_log).alias("score_rest"))
    return summed.select(id_col, "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"),
                         F.lit(model.n).cast("long").alias("train_tokens"), (F.col("base") + F.col("base_rest")).alias("base_score"),
                         (F.col("score") + F.col("score_rest")).alias("score"))
