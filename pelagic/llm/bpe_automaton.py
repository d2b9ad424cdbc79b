"""BPE encoding and decoding by a tokenization automaton.

Compilation runs one *merge gadget* per rule, in rule order.  The automaton's
labels are tokens; it starts as one state with a loop for each base symbol.
The gadget of rule ``(u, v) -> w`` at time ``k``

* cuts the arc ``v`` out of the state that ``u`` leads to (``u`` then ``v``
  would have merged),
* adds an arc ``w`` to every state that still has the arc ``u``,
* lets ``w`` lead to a copy of the state behind ``v`` as it was before ``k``.

A state therefore depends on the last token only, and the automaton accepts
exactly one path per string: its BPE encoding.  A state is a copy of an older
state plus a list of cuts, so the table keeps for each state its origin
(``right``), its birth (``rank``) and the cuts (``cut``), which is linear in the
rules; ``has_arc`` reads an arc off that table and remembers it.  ``encode``
walks a word through vocabulary trie and automaton together, left to right:
each prefix of the word is reached by one path only.  ``decode`` emits the arc
labels of a path.

Splitting (fixed by the tokenizer file): NFC, lower case, white space dropped,
then letters / one digit / other signs; special tokens found in the raw text
are arcs of their own.

Null text counts as empty (no token).  Extra columns of any name pass through
untouched; texts of any length are read whole; equal rows give equal results.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagic.llm.common import text_batches, worker_cache

# White space of the tokenizer's regular expressions.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[^{SPACE}]+")
ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"
PATH = "n_tokens long, token_ids array<int>"
CACHED_CHUNKS = 200_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    own = set(plain)
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class MergeAutomaton:
    """Deterministic tokenization automaton of a merge list (see the module text)."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str,
                 specials: dict[str, int], splitter: str):
        n = max([*vocab.values(), *specials.values()], default=-1) + 1
        self.suffix, self.specials, self.splitter = suffix, specials, splitter
        self.label = [""] * n
        for t, i in [*vocab.items(), *specials.items()]:
            self.label[i] = t
        self.rank = [-1] * n
        self.left, self.right = [-1] * n, [-1] * n
        self.cut: dict[int, int] = {}
        self.size = n
        spelled: list[tuple[int, ...]] = [()] * n
        for s in byte_symbols():
            for t in (s, s + suffix):
                if t in vocab:
                    spelled[vocab[t]] = (vocab[t],)
        for k, (a, b) in enumerate(merges):
            self._gadget(k, vocab[a], vocab[b], vocab[a + b], spelled)
        # trie over symbols; a node is (token that ends here or -1, children by symbol)
        self.trie: dict[int, list] = {}
        for i, path in enumerate(spelled):
            kids, node = self.trie, None
            for s in path:
                node = kids.setdefault(s, [-1, {}])
                kids = node[1]
            if node is not None:
                node[0] = i
        sym = byte_symbols()
        self.inner = [vocab.get(s, -1) for s in sym]
        self.final = [vocab.get(s + suffix, -1) for s in sym]
        self.ready()

    def _gadget(self, k: int, u: int, v: int, w: int, spelled: list[tuple[int, ...]]) -> None:
        self.cut[u * self.size + v] = k
        self.rank[w], self.left[w], self.right[w] = k, u, v
        spelled[w] = spelled[u] + spelled[v]

    @classmethod
    def from_file(cls, path: str) -> "MergeAutomaton":
        """Compile the automaton of a tokenizers JSON file (BPE model, one ``Split`` pre-tokenizer)."""
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        m = d["model"]
        split = next(p["pattern"]["Regex"] for p in d["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ", 1)) for x in m["merges"]]
        return cls(m["vocab"], merges, m["end_of_word_suffix"] or "",
                   {t["content"]: t["id"] for t in d["added_tokens"]}, split)

    def ready(self) -> None:
        self.arcs: dict[int, bool] = {}
        self.pieces = regex.compile(self.splitter)
        self.special_re = (re.compile("(" + "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")")
                           if self.specials else None)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("arcs", "pieces", "special_re")}

    def __setstate__(self, d):
        self.__dict__.update(d)
        self.ready()

    def _arc(self, a: int, b: int, now: int) -> bool:
        """Whether the state behind ``a`` has the arc ``b`` once all rules up to ``now`` ran."""
        rank, cut, n = self.rank, self.cut, self.size
        while True:
            k = cut.get(a * n + b)
            if k is not None and k <= now:
                return False
            if rank[b] >= rank[a]:
                if rank[b] < 0:
                    return True
                now, b = rank[b], self.left[b]
            else:
                now, a = rank[a] - 1, self.right[a]

    def has_arc(self, a: int, b: int) -> bool:
        key = a * self.size + b
        got = self.arcs.get(key)
        if got is None:
            if len(self.arcs) > 500_000:
                self.arcs.clear()
            got = self.arcs[key] = self._arc(a, b, len(self.cut))
        return got

    def encode_piece(self, piece: str) -> list[int]:
        """Token path of one pre-split piece.

        Longest arcs are tried first.  A position is reached by one path only, so
        one that leads nowhere is dead for good and no position is tried twice.
        """
        raw = piece.encode("utf-8")
        n = len(raw)
        syms = [self.inner[x] for x in raw]
        syms[-1] = self.final[raw[-1]]
        has_arc, trie = self.has_arc, self.trie
        path: list[int] = []
        at, open_, dead = [0], [], set()
        while True:
            i = at[-1]
            if len(open_) < len(at):
                ends, kids = [], trie
                for j in range(i, n):
                    node = kids.get(syms[j])
                    if node is None:
                        break
                    t, kids = node
                    if t >= 0:
                        ends.append((t, j + 1))
                open_.append(ends)
            ends = open_[-1]
            while ends:
                t, j = ends.pop()
                if j not in dead and (not path or has_arc(path[-1], t)):
                    path.append(t)
                    if j == n:
                        return path
                    at.append(j)
                    break
            else:
                dead.add(at.pop())
                open_.pop()
                path.pop()

    def chunks(self, text: str) -> Iterator[str | int]:
        """Lower-cased white-space chunks of a text, and ids of special tokens, in order."""
        parts = self.special_re.split(text) if self.special_re else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield self.specials[part]
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # no final-sigma rule
            yield from CHUNK.findall(part.lower())

    def encode_chunk(self, chunk: str | int) -> list[int]:
        if isinstance(chunk, int):
            return [chunk]
        if chunk.isalpha():
            return self.encode_piece(chunk)
        return [t for p in self.pieces.findall(chunk) for t in self.encode_piece(p)]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return [t for c in self.chunks(text) for t in self.encode_chunk(c)]

    def decode(self, ids: list[int]) -> str:
        """Arc labels of the path, joined by a space (the file names no decoder)."""
        return " ".join([self.label[i] for i in ids])


def encode_columns(spark: SparkSession, text: Column, path: str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of whole texts; ``path``: the vocabulary file."""
    text_batches(spark)
    shared = spark.sparkContext.broadcast(MergeAutomaton.from_file(path))
    name = f"bpe-digest:{path}"

    @F.pandas_udf(ENCODED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m, cache = shared.value, worker_cache(name, CACHED_CHUNKS)
        get = cache.get

        def new(c: str | int) -> tuple[str, str, int]:
            got = cache.recall(c)
            if got is None:
                ids = m.encode_chunk(c)
                cache[c] = got = (" ".join(map(str, ids)), m.decode(ids), len(ids))
            return got

        for texts in batches:
            rows = []
            for t in texts:
                parts = [get(c) or new(c) for c in m.chunks(t)] if t else []
                if not all(p[2] for p in parts):
                    parts = [p for p in parts if p[2]]  # chunks of unassigned signs have no token
                rows.append((sum([p[2] for p in parts]), hashlib.sha256(" ".join([p[0] for p in parts]).encode()).hexdigest(),
                             hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run.asNondeterministic()(text)


def bpe_encode(docs: DataFrame, path: str, text: str = "text", into: str = "token_ids") -> DataFrame:
    """``docs`` with ``into``: array of token ids of the whole text (null text: empty array)."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(MergeAutomaton.from_file(path))
    name = f"bpe-ids:{path}"

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, cache = shared.value, worker_cache(name, CACHED_CHUNKS)
        for texts in batches:
            rows = []
            for t in texts:
                ids: list[int] = []
                for c in m.chunks(t) if t else ():
                    got = cache.get(c)
                    if got is None:
                        got = cache.recall(c)
                        if got is None:
                            got = cache[c] = m.encode_chunk(c)
                    ids += got
                rows.append(ids)
            yield pd.Series(rows, dtype=object)

    return docs.withColumn(into, run(F.col(text)))


def bpe_decode(df: DataFrame, path: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """``df`` with ``into``: the arc labels of each id array, joined by a space (null array: null)."""
    text_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(MergeAutomaton.from_file(path))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for arrays in batches:
            yield pd.Series([None if a is None else shared.value.decode(list(a)) for a in arrays], dtype=object)

    return df.withColumn(into, run(F.col(ids)))
