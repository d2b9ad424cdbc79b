"""Ranked lexical search by sorted reads only (no random access), with score intervals.

A scan of the documents keeps what the queries ask for: per document its length
and the counts of the query terms it holds (a forward index, written to the
shared folder).  Document frequencies come from that index.  A ranking task then
takes its documents in blocks; in a block each term has a list of postings sorted
by impact.  A query reads its lists from the top, all to the same depth, which
doubles.  For each document seen the sum of the impacts read is a lower bound;
adding the last impact read of every list that has not shown the document yet
gives an upper bound, and the sum over all lists bounds the documents not seen.
Reading goes on until no document outside the best ``k`` can reach them (equal
scores included) and the two bounds of each one that can are equal: membership,
ties and scores are final.  A list that has shown every document still in the
race is read no further.  The best ``k`` of a task's blocks bound the next block
from below; the best of all tasks are merged last.

Terms are the maximal runs of ASCII letters, digits and code points above 127,
with only A-Z lower-cased.  ``w`` of a term is floor(1000 ln((2N+2)/(2df+1))),
``m`` of a document 75 + (25 n N) div L, a posting's impact
w ((10^9 tf) div (1000 tf + 12 m)); a score sums the impacts of the query's terms,
repeats included.

* Null or empty text has no term: not counted in N, never ranked.  Null or empty
  queries rank nothing.  Only scores above 0 are ranked.
* Ties: the smaller id first, a null id last.  Repeated rows are ranked each on
  its own; so are repeated queries.  Empty tables give an empty result.
* Texts and queries of any length are read whole, texts in chunks of ``CHUNK`` bytes.
* Other columns are not read, so their names can't clash; the result has the
  query's id, ``rank``, the document's id and ``score``.
* Queries go in blocks of about ``block_terms`` terms (spread by hash), one pass
  over the documents each: the terms and counts of one block are what the driver
  and the tasks hold.  A posting block holds ``BLOCK_DOCS`` documents.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from pelagic.llm.common import shared_folder, text_batches

# Fixed values of the contract: bytes that are no part of a term become spaces, A-Z become a-z.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
CHUNK = 4 << 20
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 4_000_000
FIRST_DEPTH = 128
MERGE_PARTS = 64
BLOCK_TERMS = 1_000_000


def term_chunks(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text (UTF-8), as lists of bounded size."""
    lo = 0
    text = text or b""
    while lo < len(text):
        hi = lo + CHUNK
        while hi < len(text) and TERM_BYTES[text[hi]] != 32:
            hi += 1
        yield text[lo:hi].translate(TERM_BYTES).split()
        lo = hi


def term_counts(text: bytes | None, number: dict[bytes, int]) -> tuple[int, Counter]:
    """All terms of a text, and the counts of those that ``number`` numbers."""
    n, found = 0, Counter()
    for terms in term_chunks(text):
        n += len(terms)
        found.update(map(number.get, terms))
    found.pop(None, None)
    return n, found


def read_lists(lists: list[tuple[np.ndarray, np.ndarray]], docs: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents whose score is among the best ``k`` and at least ``least`` (1 or more), ties included, and their scores.

    ``lists``: per query term the documents 0..docs-1 that hold it and their impacts, highest impact first.
    """
    lower = np.zeros(docs, np.int64)
    depth, at = FIRST_DEPTH, [0] * len(lists)
    last = np.array([i[0] if len(i) else 0 for _, i in lists], np.int64)  # bound of what a list still holds
    shut = [len(i) == 0 for _, i in lists]
    while True:
        for j, (d, i) in enumerate(lists):
            if not shut[j] and at[j] < len(d):
                hi = min(depth, len(d))
                lower[d[at[j]:hi]] += i[at[j]:hi]  # a list holds a document once
                at[j] = hi
                last[j] = i[hi - 1] if hi < len(d) else 0
        unseen = int(last.sum())
        upper = lower + unseen
        for j, (d, _) in enumerate(lists):
            if last[j]:
                upper[d[:at[j]]] -= last[j]
        kth = int(np.partition(lower, docs - k)[docs - k]) if docs > k else 0
        floor = max(kth, least)
        race = upper >= floor
        if unseen < floor:  # a document not seen can't enter
            race &= lower > 0
            open_docs = race & (upper > lower)
            if not open_docs.any():
                found = np.flatnonzero(race & (lower >= floor))
                return found, lower[found]
            n = int(open_docs.sum())
            for j, (d, _) in enumerate(lists):
                shut[j] = shut[j] or not last[j] or int(open_docs[d[:at[j]]].sum()) == n
        depth *= 2


class Ranker:
    """The best ``k`` of each query over the blocks of one task."""

    def __init__(self, queries: list[dict[int, int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
        self.queries, self.weights, self.n_docs, self.n_terms, self.k = queries, weights, n_docs, n_terms, k
        self.best: list[tuple[np.ndarray, pa.Array] | None] = [None] * len(queries)

    def impacts(self, terms: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 75 + 25 * n * self.n_docs // self.n_terms
        return self.weights[terms] * (1_000_000_000 * tf // (1000 * tf + 12 * m))

    def block(self, ids: pa.Array, n: np.ndarray, terms: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> None:
        docs = len(ids)
        place = np.empty(docs, np.int64)  # documents are numbered in the order of their ids
        place[pc.array_sort_indices(ids, order="ascending").to_numpy()] = np.arange(docs)
        ids = ids.take(pc.array_sort_indices(ids, order="ascending"))
        impact = self.impacts(terms, tf, np.repeat(n, lengths))
        held = np.repeat(place, lengths)
        order = np.lexsort((held, -impact, terms))
        order = order[impact[order] > 0]
        terms, held, impact = terms[order], held[order], impact[order]
        starts = np.searchsorted(terms, np.arange(len(self.weights) + 1))
        for number, query in enumerate(self.queries):
            lists = [(held[starts[t]:starts[t + 1]], impact[starts[t]:starts[t + 1]] * times) for t, times in query.items()
                     if starts[t] < starts[t + 1]]
            if not lists:
                continue
            had = self.best[number]
            least = int(had[0][-1]) if had is not None and len(had[0]) == self.k else 1
            found, score = read_lists(lists, docs, self.k, max(least, 1))
            first = np.lexsort((found, -score))[:self.k]
            self._keep(number, score[first], ids.take(pa.array(found[first])))

    def _keep(self, number: int, score: np.ndarray, ids: pa.Array) -> None:
        had = self.best[number]
        if had is not None:
            score, ids = np.concatenate([had[0], score]), pa.concat_arrays([had[1], ids])
            t = pa.table({"score": score, "id": ids})
            first = pc.sort_indices(t, [("score", "descending"), ("id", "ascending")])[:self.k]
            score, ids = score[first.to_numpy()], ids.take(first)
        self.best[number] = score, ids


def search(docs: DataFrame, items: DataFrame, k: int = 20, *, id_col: str = "doc_id", text: str = "text",
           item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents of each query: item id, rank (from 1), document id, score."""
    spark = docs.sparkSession
    text_batches(spark)
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("words"))
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("words"))
    size = asked.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = size // (4 * block_terms) + 1
    parts = []
    for b in range(blocks):
        some = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b)
        parts.append(_search_block(found, some.toArrow(), k))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    names = {"item": item_col, "id": id_col}
    return out.select(*[F.col(c).alias(names.get(c, c)) for c in ("item", "rank", "id", "score")])


def _search_block(docs: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    spark = docs.sparkSession
    number: dict[bytes, int] = {}
    queries: list[dict[int, int]] = []
    for words in asked.column("words").to_pylist():
        q: dict[int, int] = {}
        for terms in term_chunks(words):
            for t in terms:
                j = number.setdefault(t, len(number))
                q[j] = q.get(j, 0) + 1
        queries.append(q)
    item_ids = asked.column("item").combine_chunks()
    if isinstance(item_ids, pa.ChunkedArray):
        item_ids = pa.concat_arrays(item_ids.chunks) if item_ids.num_chunks else pa.array([], item_ids.type)

    # forward index of the asked terms
    terms_known = spark.sparkContext.broadcast(number)
    id_field = docs.schema["id"]
    longs, ints = ArrayType(LongType()), ArrayType(IntegerType())
    index_schema = StructType([id_field, StructField("n", LongType()), StructField("terms", ints), StructField("tf", longs)])

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms_known.value
        for batch in batches:
            n, ends, terms, tf = [], [0], [], []
            for words in batch.column(1):
                size, found = term_counts(words.as_py(), known)
                n.append(size)
                terms += found.keys()
                tf += found.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))], names=["id", "n", "terms", "tf"])

    folder = f"{shared_folder(spark)}/lexical-index-{uuid.uuid4()}"
    docs.mapInArrow(count_terms, index_schema).filter("n > 0").write.parquet(folder)
    index = spark.read.schema(index_schema).parquet(folder)
    n_docs, n_terms = index.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(number), np.int64)
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # one row per asked term
        df[r["t"]] = r["count"]
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)

    plan = spark.sparkContext.broadcast((queries, item_ids, weights, n_docs, n_terms or 1))
    item_field = StructField("item", spark.createDataFrame(asked.select(["item"]).slice(0, 0)).schema["item"].dataType)
    best_schema = StructType([StructField("q", IntegerType()), StructField("part", IntegerType()), item_field, id_field,
                              StructField("score", LongType())])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, item_ids, weights, n_docs, n_terms = plan.value
        r = Ranker(queries, weights, n_docs, n_terms, k)
        held, rows, postings = [], 0, 0

        def flush() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            terms, tf = t.column("terms").chunk(0), t.column("tf").chunk(0)
            r.block(t.column("id").chunk(0), t.column("n").to_numpy(), terms.flatten().to_numpy().astype(np.int64),
                    tf.flatten().to_numpy(), pc.list_value_length(terms).to_numpy().astype(np.int64))

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
                postings += len(batch.column("terms").flatten())
                if rows >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    flush()
                    held, rows, postings = [], 0, 0
        if held:
            flush()
        part = TaskContext.get().partitionId() % MERGE_PARTS
        for q, best in enumerate(r.best):
            if best is not None and len(best[0]):
                n = len(best[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * n, pa.int32()), pa.array([part] * n, pa.int32()), item_ids.take(pa.array([q] * n)),
                     best[1].combine_chunks() if isinstance(best[1], pa.ChunkedArray) else best[1], pa.array(best[0], pa.int64())],
                    names=["q", "part", "item", "id", "score"])

    best = index.mapInArrow(rank, best_schema)
    by_score = [F.desc("score"), F.asc_nulls_last("id")]
    some = best.withColumn("r", F.row_number().over(W.partitionBy("q", "part").orderBy(*by_score))).filter(F.col("r") <= k)
    final = some.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(*by_score))).filter(F.col("rank") <= k)
    return final.select("item", "rank", "id", "score")
