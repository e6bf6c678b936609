"""Operator 12: ranked lexical search by the Best Position Algorithm.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters,
A-Z lower-cased.  A document scores, for each term of the query (repeats
included), the term's weight times the document's impact for it; weights and
impacts are integers, see ``weight`` and ``impacts``.

One pass over the texts writes, per document, its number of terms and the
counts of the terms that some query has.  The documents are then searched where
they lie, without a shuffle: each task cuts its documents into shards of
bounded size and builds, for each query term, the list of the shard's documents
by falling impact.  A query reads its lists from the top.  For each document
met, a direct access finds its impact and its position in all the query's
lists, so every list knows its best position: the last one of the unbroken run
of positions seen from the top.  No unseen document can score more than the
impacts at the best positions give, so a query stops when that sum is strictly
below its k-th score (a document with an equal score could still win by its
doc_id).  Lists are read in steps that double, and the k best of a task's
earlier shards raise the k-th score from the start.  The best of all tasks are
merged per query in two rounds, the first one by salts.

The queries are read in blocks of at most about ``BLOCK_CHARS`` characters, a
pass each, so what is broadcast (a block's terms and their weights) does not
grow with the queries.

Edge cases: a null text, or one without a term, is no document; each row is a
document of its own, so repeated rows rank beside each other, in any order;
a null doc_id is ranked after the others of its score; an item without a term,
or whose terms no document has, gets no row; repeated items count once, items
that differ only in text are ranked each for itself; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.llm.common import materialize

K = 20
BLOCK_CHARS = 2_000_000
#: A shard ends at so many documents or list entries.
SHARD_DOCS = 1 << 15
SHARD_ENTRIES = 1 << 21
FIRST_STEP = 64
SALTS = 64
#: Bytes of a text that are split at once.
PART = 1 << 20
#: The null doc_id, last of all.
_NO_ID = np.iinfo(np.int64).max

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text's UTF-8 bytes, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = at + PART
        part = text[at:end].translate(_FOLD)
        while end < len(text) and not part.endswith(b" "):  # do not cut a term
            more = text[end:end + 256].translate(_FOLD)
            blank = more.find(b" ")
            part += more if blank < 0 else more[:blank + 1]
            end += len(more) if blank < 0 else blank + 1
        yield part.split()
        at = end


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 75 + 25 * n * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _count(vocabulary: dict[bytes, int]):
    """Per document with a term: doc_id, n, and the query terms it has with their counts."""

    def count(batches):
        for batch in batches:
            ids, lengths, which, tfs, sizes = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                n, found = 0, Counter()
                for words in terms(text.as_py() or b""):
                    n += len(words)
                    found.update(filter(vocabulary.__contains__, words))
                if n:
                    ids.append(doc_id)
                    lengths.append(n)
                    numbers = sorted((vocabulary[w], c) for w, c in found.items())
                    which.extend(t for t, _ in numbers)
                    tfs.extend(c for _, c in numbers)
                    sizes.append(len(which))
            offsets = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(which, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])

    return count


class Shard:
    """Impact lists of a set of documents, with direct access by term and document."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int):
        self.n_docs = n_docs
        ranked = np.lexsort((doc, -impact, term))
        self.docs, self.impacts = doc[ranked], impact[ranked]
        sorted_terms = term[ranked]
        self.terms, self.first = np.unique(sorted_terms, return_index=True)
        self.end = np.append(self.first[1:], len(ranked))
        keys = sorted_terms * n_docs + self.docs
        by_key = np.argsort(keys, kind="stable")
        self.keys, self.where = keys[by_key], by_key

    def search(self, query: np.ndarray, weights: np.ndarray, ids: np.ndarray, floor: int, k: int, step: int = FIRST_STEP):
        """(documents, scores, direct accesses): all documents that may be among the ``k`` best.

        ``query`` holds distinct terms, ``weights`` what an impact of each
        counts, ``floor`` the k-th score that is known from elsewhere.
        """
        at = np.searchsorted(self.terms, query)
        has = at < len(self.terms)
        has[has] = self.terms[at[has]] == query[has]
        query, weights, lists = query[has], weights[has], at[has]
        nothing = np.zeros(0, dtype=np.int64)
        if not len(lists):
            return nothing, nothing, 0
        first, end = self.first[lists], self.end[lists]
        best = np.zeros(len(lists), dtype=np.int64)  # entries seen from the top without a gap
        seen = [np.zeros(e - f, dtype=bool) for f, e in zip(first, end)]
        met = np.zeros(self.n_docs, dtype=bool)
        found, scores, accesses = [nothing], [nothing], 0
        kth = floor
        while True:
            fresh = []
            for i in np.flatnonzero(best < end - first):
                a = first[i] + best[i]
                fresh.append(self.docs[a:min(a + step, end[i])])
            docs = np.unique(np.concatenate(fresh))
            docs = docs[~met[docs]]
            if len(docs):
                met[docs] = True
                want = (query[:, None] * self.n_docs + docs[None, :]).reshape(-1)
                place = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
                hit = self.keys[place] == want
                accesses += len(want)
                entry = self.where[place]
                own = np.where(hit, self.impacts[entry], 0).reshape(len(query), -1)
                score = weights @ own
                found.append(docs)
                scores.append(score)
                entry, hit = entry.reshape(own.shape), hit.reshape(own.shape)
                for i in range(len(lists)):
                    seen[i][entry[i][hit[i]] - first[i]] = True
                so_far = np.concatenate(scores)
                if len(so_far) >= k:
                    kth = max(floor, int(np.partition(so_far, len(so_far) - k)[len(so_far) - k]))
            bound = 0
            for i in range(len(lists)):
                gap = seen[i][best[i]:].argmin() if not seen[i][best[i]:].all() else len(seen[i]) - best[i]
                best[i] += gap
                if best[i] < len(seen[i]):
                    bound += int(weights[i]) * int(self.impacts[first[i] + best[i] - 1])
            if bound < max(kth, 1) or bool((best >= end - first).all()):
                break
            step *= 2
        docs, scores = np.concatenate(found), np.concatenate(scores)
        good = (scores > 0) & (scores >= kth)
        docs, scores = docs[good], scores[good]
        order = np.lexsort((ids[docs], -scores))[:k]
        return docs[order], scores[order], accesses


def _shards(batches, n_docs: int, n_terms: int):
    """(shard, doc_ids) of the rows of ``_count``, cut by documents and entries."""
    parts, docs, entries = [], 0, 0

    def close():
        ids, n, sizes, which, tfs = (np.concatenate([p[i] for p in parts]) for i in range(5))
        doc = np.repeat(np.arange(len(ids)), sizes)
        return Shard(which.astype(np.int64), doc, impacts(tfs, n[doc], n_docs, n_terms), len(ids)), ids

    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            flat = [batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3)]
            parts.append((ids, batch.column(1).to_numpy(zero_copy_only=False), sizes, *flat))
            docs, entries = docs + len(ids), entries + len(flat[0])
            if docs >= SHARD_DOCS or entries >= SHARD_ENTRIES:
                yield close()
                parts, docs, entries = [], 0, 0
    if docs:
        yield close()


def _search(shared, k: int):
    """The best documents of a task for each query of ``shared``."""

    def search(batches):
        queries, n_docs, n_terms = shared.value
        none = np.zeros(0, dtype=np.int64)
        top = [(none, none)] * len(queries)  # scores and doc_ids, best first
        for shard, ids in _shards(batches, n_docs, n_terms):
            for q, (_, which, weights) in enumerate(queries):
                floor = int(top[q][0][k - 1]) if len(top[q][0]) >= k else 0
                docs, scores, _ = shard.search(which, weights, ids, floor, k)
                if len(docs):
                    scores, doc_ids = np.concatenate([top[q][0], scores]), np.concatenate([top[q][1], ids[docs]])
                    order = np.lexsort((doc_ids, -scores))[:k]
                    top[q] = scores[order], doc_ids[order]
        numbers = np.repeat(np.arange(len(queries)), [len(s) for s, _ in top])
        scores, doc_ids = (np.concatenate([none, *(t[i] for t in top)]) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(doc_ids, mask=doc_ids == _NO_ID), pa.array(scores)],
            names=["query", "doc_id", "score"])

    return search


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in bounded blocks on the driver."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for i in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r.item_id, r.text) for r in block.collect()]


def _rank_block(docs: DataFrame, block: list[tuple[int, str]], k: int) -> DataFrame:
    spark = docs.sparkSession
    counted = [(i, Counter(w for part in terms(t.encode()) for w in part)) for i, t in block]
    vocabulary = {w: n for n, w in enumerate(sorted({w for _, c in counted for w in c}))}
    shared_words = spark.sparkContext.broadcast(vocabulary)

    def count(batches):
        return _count(shared_words.value)(batches)

    lists = materialize(docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>"), "search-lists")
    size = lists.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = size["docs"], size["terms"] or 0
    # One row for each term of the block.
    df = {r["term"]: r["df"] for r in
          lists.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    queries = []
    for _, found in counted:
        numbers = sorted((vocabulary[w], c) for w, c in found.items() if vocabulary[w] in df)
        queries.append((np.array([t for t, _ in numbers], dtype=np.int64),
                        np.array([c * weight(n_docs, df[t]) for t, c in numbers], dtype=np.int64)))
    shared = spark.sparkContext.broadcast(([(q, *x) for q, x in enumerate(queries)], n_docs, n_terms))
    best = lists.mapInArrow(_search(shared, k), "query long, doc_id long, score long")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    salted = Window.partitionBy("query", "salt").orderBy(*order)
    best = (best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k))
    ranked = (best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
              .where(F.col("rank") <= k))
    names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], "query long, item_id long")
    return ranked.join(F.broadcast(names), "query").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best rows of ``docs(doc_id, text)`` for each of ``items(item_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in _blocks(items):
        ranked = _rank_block(docs, block, k)
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else docs.sparkSession.createDataFrame(
        [], "item_id long, rank int, doc_id long, score long")
