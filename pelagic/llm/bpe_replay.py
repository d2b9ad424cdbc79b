"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words (matches of the split pattern) of a batch of documents are
laid out as one long row of byte tokens.  An inverted index maps each token pair
that has a rank to the positions where it stands.  The merges are replayed in
rank order over all words at once: a merge visits the positions of its pair
only, joins the two tokens, and enters the pairs that its left and right
neighbours form now; nothing else is touched.  Words never meet (the last token
of a word has no right neighbour), so replaying a batch of words gives what
replaying the whole corpus would, and no word has to be shuffled.  What a worker
has replayed it remembers in a bounded cache.

Only one pair can ever make a token, if the ranks are those of a merge list
(``MergeReplay`` derives the pairs and raises if they are not): then one pass in
rank order equals merging each word's lowest pair again and again.

Letters, numbers and white space of the pattern are those of the library that
the ranks are for; ``unknown_signs`` lists code points that the local tables
class otherwise.

* Null text: empty, no token.  Empty text: no token.  Null ids decode to null.
* Ties: of equal pairs that overlap the left one merges first.
* Repeated rows give equal results; an empty table gives an empty table.
* Texts of any length are read whole; a word of any length is one word (words
  above ``CACHED_BYTES`` bytes are replayed each time instead of remembered).
* Columns of any name pass through; ``into`` replaces a column of its name.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagic.llm.common import BoundedCache, text_batches, worker_cache

ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"
CACHED_WORDS = 200_000
CACHED_BYTES = 64
STREAMED_CHARS = 4_000_000  # words of longer texts are taken one by one, not as a list


class MergeReplay:
    """Merges of a rank file, replayed over many words at once (see the module text)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.size = max(ranks.values()) + 1
        # token -> (left, right, bytes of left, bytes of both); neighbour -> token it makes with this one
        self.made: list[tuple[int, int, int, int] | None] = [None] * self.size
        self.with_right: list[dict[int, int]] = [{} for _ in range(self.size)]
        self.with_left: list[dict[int, int]] = [{} for _ in range(self.size)]
        for word, rank in sorted(ranks.items(), key=lambda x: x[1]):
            halves = self._halves(word, rank, ranks) if len(word) > 1 else None
            if halves:
                left, right = ranks[halves[0]], ranks[halves[1]]
                self.made[rank] = left, right, len(halves[0]), len(word)
                self.with_right[left][right] = self.with_left[right][left] = rank
        self.byte_pair = np.array([[self.with_right[a].get(b, -1) for b in self.byte.tolist()] for a in self.byte.tolist()], np.int64)

    @staticmethod
    def _halves(word: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes ``word`` (None if no merge ever does)."""
        parts = [word[i:i + 1] for i in range(len(word))]
        late = False
        while len(parts) > 2:
            r, i = min((ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if r == 1 << 62:
                return None
            late = late or r > rank
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if late:
            raise ValueError(f"the ranks are no merge list: {word!r} is made of later tokens")
        return parts[0], parts[1]

    @classmethod
    def from_file(cls, path: str) -> "MergeReplay":
        """Read a rank file: one line a token, base64 and rank."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)})

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word."""
        if not words:
            return []
        with_right, with_left = self.with_right, self.with_left
        # a token stands at its first byte; -1 between words (no pair holds it), -2 inside a token
        signs = np.frombuffer(b"\0%b\0" % b"\0".join(words), np.uint8)
        gaps = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words], dtype=np.int64)])
        tokens = self.byte[signs]
        tokens[gaps] = -1
        tok = tokens.tolist()
        first = list(range(len(tok)))  # by last byte of a token: its first byte

        # inverted index: token that a pair makes -> places of the pair
        index: list[list[int]] = [[] for _ in range(self.size)]
        pairs = self.byte_pair[signs[:-1], signs[1:]]
        pairs[gaps[:-1]] = pairs[gaps[1:] - 1] = -1
        order = np.argsort(pairs, kind="stable")
        made, begin = np.unique(pairs[order], return_index=True)
        for m, places in zip(made.tolist(), np.split(order, begin[1:])):
            if m >= 0:
                index[m] = places.tolist()
        for made, places in enumerate(index):  # merges in rank order; each adds to later places only
            if not places:
                continue
            left, right, step, size = self.made[made]
            if left == right:
                places.sort()  # of overlapping pairs the left one merges first
            to_right, to_left = with_right[made], with_left[made]
            for p in places:
                q = p + step
                if tok[p] != left or tok[q] != right:
                    continue  # a neighbour has merged since
                tok[p], tok[q] = made, -2
                end = p + size
                first[end - 1] = p
                if to_right:
                    new = to_right.get(tok[end])
                    if new is not None:
                        index[new].append(p)
                if to_left:
                    b = first[p - 1]
                    new = to_left.get(tok[b])
                    if new is not None:
                        index[new].append(b)
        out, at = [], 1
        for w in words:
            out.append([t for t in tok[at:at + len(w)] if t >= 0])
            at += len(w) + 1
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of the tokens, joined."""
        return b"".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=4)
def unknown_signs(cls: str) -> str:
    """Code points that the local tables put in ``cls`` (a pattern) and the library doesn't, or the reverse."""
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    probe = tiktoken.Encoding("probe", pat_str=cls, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    theirs = set(bytes(probe.encode_ordinary(every)).decode())
    return "".join(sorted(theirs ^ set(regex.findall(cls, every))))


def ranges(signs: str) -> str:
    """Sorted code points as the inside of a character set."""
    runs: list[list[int]] = []
    for c in map(ord, signs):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in runs)


class Splitter:
    """The split pattern as the library applies it: texts that hold a sign classed otherwise take the corrected pattern.

    Made once on the driver; workers get the pattern and the signs.
    """

    def __init__(self, pattern: str):
        self.pattern = self.corrected = pattern
        signs = ""
        for cls in (r"\p{L}", r"\p{N}"):
            other = unknown_signs(cls) if cls in pattern else ""
            if other:
                self.corrected = self.corrected.replace(cls, f"[{cls}~~[{ranges(other)}]]")
                signs += other
        self.signs = frozenset(signs)

    def words(self, text: str) -> Iterable[str]:
        odd = not text.isascii() and not self.signs.isdisjoint(text)
        find = regex.compile(self.corrected, regex.V1) if odd else regex.compile(self.pattern)
        if len(text) > STREAMED_CHARS:
            return (m.group() for m in find.finditer(text))
        return find.findall(text)


class BatchEncoder:
    """Encodes batches of texts; words are replayed once per batch and remembered in the worker's cache."""

    def __init__(self, replay: MergeReplay, splitter: Splitter, cache: BoundedCache):
        self.replay, self.splitter, self.cache = replay, splitter, cache

    def encode(self, texts: Iterable[str | None]) -> tuple[list[array], list[tuple[int, bytes, bytes]]]:
        """Per text the numbers of its words; per word (tokens, ids as little-endian uint32, decoded bytes)."""
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        coded = [array("L", map(number.__getitem__, self.splitter.words(t))) if t else array("L") for t in texts]
        cache = self.cache
        known = [cache.get(w) or cache.recall(w) for w in number]
        new = [w for w, k in zip(number, known) if k is None]
        made = iter(self.replay.replay([w.encode() for w in new]))
        for i, (w, k) in enumerate(zip(number, known)):
            if k is None:
                ids = next(made)
                known[i] = k = len(ids), array("I", ids).tobytes(), self.replay.decode(ids)
                if len(k[2]) <= CACHED_BYTES:
                    cache[w] = k
        return coded, known


def _shared(spark: SparkSession, path: str, pattern: str):
    """Merges and split pattern, compiled once and broadcast: bounded by the rank file."""
    text_batches(spark)
    return spark.sparkContext.broadcast((MergeReplay.from_file(path), Splitter(pattern)))


def digest_column(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of whole texts; ``path``: the rank file."""
    shared = _shared(spark, path, pattern)

    @F.pandas_udf(ENCODED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = BatchEncoder(*shared.value, worker_cache(f"bpe-replay:{path}:{pattern}", CACHED_WORDS))
        for texts in batches:
            coded, words = enc.encode(texts)
            size, ids, plain = ([w[k] for w in words] for k in range(3))
            rows = [(sum(map(size.__getitem__, c)), hashlib.sha256(b"".join(map(ids.__getitem__, c))).hexdigest(),
                     hashlib.sha256(b"".join(map(plain.__getitem__, c))).hexdigest()) for c in coded]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run.asNondeterministic()(text)  # one call for its three fields


def byte_encode(docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "token_ids") -> DataFrame:
    """``docs`` with ``into``: array of token ids of the whole text (null text: empty array)."""
    shared = _shared(docs.sparkSession, path, pattern)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = BatchEncoder(*shared.value, worker_cache(f"bpe-replay:{path}:{pattern}", CACHED_WORDS))
        for texts in batches:
            coded, words = enc.encode(texts)
            ids = [w[1] for w in words]
            yield pd.Series([array("I", b"".join(map(ids.__getitem__, c))).tolist() for c in coded], dtype=object)

    return docs.withColumn(into, run(F.col(f"`{text}`")))


def byte_decode(df: DataFrame, path: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """``df`` with ``into``: the bytes of each id array (null array: null); cast to string where they are UTF-8."""
    text_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(MergeReplay.from_file(path))

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for arrays in batches:
            yield pd.Series([None if a is None else m.decode(a) for a in arrays], dtype=object)

    return df.withColumn(into, run(F.col(f"`{ids}`")))
