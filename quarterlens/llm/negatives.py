"""Operator 13: hard negatives by coordinate pruning in length buckets.

Vectors are integer (each component x is floor(256 x)); an anchor's positives
are the ``POSITIVES`` best other rows of its label, and the negatives of a
positive are the ``NEGATIVES`` best rows of other labels whose score is at
least ``LEAST`` and at most ``MOST`` percent of the positive's.  Scores are
integer inner products, ties go to the smaller vec_id.

The rows are range-partitioned by falling length and packed, each task's rows
in buckets of about equal length that hold, per coordinate, the bucket's
vectors sorted by that coordinate of their direction.  To reach a score t an
anchor a needs a cosine of t / (|a| l) with l the bucket's greatest length; a
bucket where that exceeds 1 is skipped.  In the others the angle between the
directions bounds each coordinate of a partner to a range.  The ranges of the
anchor's ``FOCUS`` largest coordinates are looked up in the sorted lists, and
the rows that stand in all of them are verified by their exact product.

The anchors are searched twice, for positives and then for negatives.  They go
to the tasks in blocks of ``ANCHOR_BLOCK``, a pass each over the packed
buckets; a task carries its best from bucket to bucket, so that t rises, and
the best of all tasks are merged per anchor.  A group of equal rows of any size
is one entry of a bucket with the few smallest ids that a result can show.

Edge cases: rows with a null vec_id or label, or a vector that is null, empty
or holds a null or non-finite component, take no part, nor do vectors whose
products may not fit 64 bits (a length of 3e9 or more after scaling); only
vectors of equally many components are compared; rows with equal vec_id, label
and vector count once, and rows with the anchor's vec_id are never its
partners; an anchor without positives, or a positive without negatives, gets no
row; a positive score under 0 has no negatives; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.llm.common import materialize

ANCHOR_MOD, NOISE_MOD, LABELS = 50, 7, 10
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95
FOCUS = 4
#: Components of a bucket's vectors, and anchors of a block; they shape the cost, not the result.
BUCKET_CELLS = 1 << 17
ANCHOR_BLOCK = 1 << 14
SALTS = 16
#: Vectors of this length or more take no part.
_LONGEST = 3e9
#: Slack of the pruning against rounding; exact products decide.
_SLACK = 1e-9

_BUCKET = "dim int, ids binary, labels binary, groups binary, vectors binary, lengths binary, orders binary"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, v (integer vector), norm2 of the rows that take part, labels after the noise rule."""
    x = F.col("embedding")
    finite = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LONGEST))
    label = F.when(F.col("vec_id") % NOISE_MOD == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))
    known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.col("embedding").cast("array<double>").alias("embedding"))
    known = known.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    return (known.select("vec_id", label.alias("label"), scaled.alias("v"))
            .withColumn("norm2", norm2).where(F.col("norm2") < _LONGEST ** 2))


def _equal_rows(ids, labels, vectors, keep: int):
    """Groups of equal label and vector: (ids of group members, group of each, first member), at most ``keep`` ids a group."""
    key = np.concatenate([labels[:, None], vectors], axis=1)
    _, group = np.unique(key, axis=0, return_inverse=True)
    group = group.reshape(-1)
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    fresh = np.ones(len(g), dtype=bool)
    fresh[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1])  # a repeated row counts once
    order, g = order[fresh], g[fresh]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    place = np.arange(len(g)) - starts[np.cumsum(np.concatenate([[0], (g[1:] != g[:-1]).astype(int)]))]
    return ids[order[place < keep]], g[place < keep], order[starts]


def _pack(batches):
    """Buckets of a task's rows, longest first."""
    held: dict[int, list] = {}
    for batch in batches:
        dims = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            flat = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            held.setdefault(int(dim), []).append(
                (part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False), flat))
    for dim, parts in held.items():
        ids, labels, vectors = (np.concatenate([p[i] for p in parts]) for i in range(3))
        members, group, first = _equal_rows(ids, labels, vectors, max(POSITIVES, NEGATIVES) + 1)
        labels, vectors = labels[first], vectors[first]
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        size = max(32, BUCKET_CELLS // dim)
        for at in range(0, len(order), size):
            rows = order[at:at + size]
            new = np.full(len(first), -1)
            new[rows] = np.arange(len(rows))
            inside = new[group] >= 0
            direction = vectors[rows] / np.maximum(lengths[rows], 1e-300)[:, None]
            columns = [np.array([dim], np.int32), members[inside], labels[rows], new[group[inside]], vectors[rows],
                       lengths[rows], np.argsort(direction, axis=0, kind="stable").T.astype(np.int32)]
            arrays = [pa.array(columns[0]), *(pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=["dim", "ids", "labels", "groups", "vectors", "lengths", "orders"])


class Bucket:
    """One length bucket with its sorted coordinate lists."""

    def __init__(self, dim, ids, labels, groups, vectors, lengths, orders):
        self.dim = dim
        self.ids, self.groups = np.frombuffer(ids, np.int64), np.frombuffer(groups, np.int64)
        self.labels, self.lengths = np.frombuffer(labels, np.int64), np.frombuffer(lengths, np.float64)
        self.vectors = np.frombuffer(vectors, np.int64).reshape(-1, dim)
        self.floats = self.vectors.astype(np.float64)
        self.orders = np.frombuffer(orders, np.int32).reshape(dim, -1)
        direction = self.floats / np.maximum(self.lengths, 1e-300)[:, None]
        self.lists = np.take_along_axis(direction.T, self.orders, axis=1)
        self.longest = float(self.lengths[0])
        # The members of each group, by group.
        self.order = np.argsort(self.groups, kind="stable")
        self.first = np.searchsorted(self.groups[self.order], np.arange(len(self.labels) + 1))

    @classmethod
    def read(cls, batches) -> Iterator[Bucket]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                yield cls(*row)

    def candidates(self, direction: np.ndarray, length: float, least: int) -> np.ndarray:
        """The groups that may have a product of ``least`` or more with a vector of this direction and length."""
        n = len(self.labels)
        if least <= 0:
            return np.arange(n)
        reach = length * self.longest
        if least > reach * (1 + _SLACK):
            return np.zeros(0, dtype=np.int64)
        angle = np.arccos(min(1.0, least / reach)) + 1e-7
        counts = np.zeros(n, dtype=np.int8)
        focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
        for f in focus:
            own = np.arccos(np.clip(direction[f], -1, 1))
            low, high = np.cos(min(np.pi, own + angle)) - _SLACK, np.cos(max(0.0, own - angle)) + _SLACK
            a, b = np.searchsorted(self.lists[f], low, "left"), np.searchsorted(self.lists[f], high, "right")
            counts[self.orders[f, a:b]] += 1
        return np.flatnonzero(counts == len(focus))

    def products(self, rows: np.ndarray, vector: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products."""
        if length * self.longest < 2 ** 53:  # then no partial sum leaves the whole doubles
            return (self.floats[rows] @ vector.astype(np.float64)).astype(np.int64)
        return (self.vectors[rows] * vector).sum(axis=1)

    def expand(self, rows: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vec_ids, scores) of the members of the groups."""
        count = self.first[rows + 1] - self.first[rows]
        edges = np.concatenate([[0], np.cumsum(count)])
        gather = np.repeat(self.first[rows] - edges[:-1], count) + np.arange(edges[-1])
        return self.ids[self.order[gather]], np.repeat(scores, count)


_NONE = np.zeros(0, dtype=np.int64)


def _better(top: tuple, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple:
    """The ``k`` best distinct (score, id) of both."""
    ids, scores = np.concatenate([top[0], ids]), np.concatenate([top[1], scores])
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
    return ids[fresh][:k], scores[fresh][:k]


def _by_dim(anchors):
    """Anchors as (number, vec_id, label, vector, direction, length, ...), by number of components."""
    out: dict[int, list] = {}
    for number, (vec_id, label, vector, *more) in enumerate(anchors):
        length = float(np.sqrt((vector.astype(np.float64) ** 2).sum()))
        out.setdefault(len(vector), []).append((number, vec_id, label, vector, vector / max(length, 1e-300), length, *more))
    return out


def _positives(shared):
    def search(batches):
        anchors = _by_dim(shared.value)
        top = {a[0]: (_NONE, _NONE) for some in anchors.values() for a in some}
        for bucket in Bucket.read(batches):
            for number, vec_id, label, vector, direction, length in anchors.get(bucket.dim, ()):
                ids, scores = top[number]
                # An equal score may still win by its id.
                least = int(scores[POSITIVES - 1]) if len(scores) >= POSITIVES else None
                rows = (bucket.candidates(direction, length, least) if least is not None
                        else np.arange(len(bucket.labels)))
                rows = rows[bucket.labels[rows] == label]
                if not len(rows):
                    continue
                found = bucket.products(rows, vector, length)
                if least is not None:
                    rows, found = rows[found >= least], found[found >= least]
                found_ids, found = bucket.expand(rows, found)
                other = found_ids != vec_id
                top[number] = _better(top[number], found_ids[other], found[other], POSITIVES)
        yield _rows([(n, 0, i, s) for n, (ids, scores) in top.items() for i, s in zip(ids.tolist(), scores.tolist())])

    return search


def _negatives(shared):
    def search(batches):
        anchors = _by_dim(shared.value)
        top = {(a[0], j): (_NONE, _NONE) for some in anchors.values() for a in some for j in range(len(a[6]))}
        for bucket in Bucket.read(batches):
            for number, vec_id, label, vector, direction, length, positives in anchors.get(bucket.dim, ()):
                bounds = []
                for j, score in enumerate(positives):
                    scores = top[number, j][1]
                    low = -(-score * LEAST // 100)
                    bounds.append(max(low, int(scores[NEGATIVES - 1])) if len(scores) >= NEGATIVES else low)
                if not bounds:
                    continue
                rows = bucket.candidates(direction, length, min(bounds))
                rows = rows[bucket.labels[rows] != label]
                if not len(rows):
                    continue
                products = bucket.products(rows, vector, length)
                for j, (score, least) in enumerate(zip(positives, bounds)):
                    good = (products >= least) & (100 * products <= MOST * score)
                    if not good.any():
                        continue
                    some, found = rows[good], products[good]
                    if len(found) > NEGATIVES + 1:  # one may hold the anchor's own id alone
                        last = np.partition(found, len(found) - NEGATIVES - 1)[len(found) - NEGATIVES - 1]
                        some, found = some[found >= last], found[found >= last]
                    found_ids, found = bucket.expand(some, found)
                    other = found_ids != vec_id
                    top[number, j] = _better(top[number, j], found_ids[other], found[other], NEGATIVES)
        yield _rows([(n, j, i, s) for (n, j), (ids, scores) in top.items() for i, s in zip(ids.tolist(), scores.tolist())])

    return search


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "positive", "vec_id", "score"])


def _merged(best: DataFrame, k: int) -> DataFrame:
    """The ``k`` best (vec_id, score) of all tasks, by anchor and positive, with their rank."""
    order = (F.col("score").desc(), F.col("vec_id"))
    best = best.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for by in (["anchor", "positive", "salt"], ["anchor", "positive"]):
        best = (best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
                .where(F.col("rank") <= k))
    return best.drop("salt")


def _blocks(anchors: DataFrame) -> Iterator[list]:
    """Blocks of distinct anchors on the driver: (vec_id, label, vector)."""
    anchors = anchors.select("vec_id", "label", "v").distinct()
    n = -(-anchors.count() // ANCHOR_BLOCK)
    for i in range(n):
        block = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(n)) == i).toArrow()
        v = block.column("v").combine_chunks()
        flat, ends = v.flatten().to_numpy(), np.cumsum(v.value_lengths().to_numpy())
        yield list(zip(block.column("vec_id").to_pylist(), block.column("label").to_pylist(), np.split(flat, ends[:-1])))


def hard_negatives(rows: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ``rows(vec_id, embedding, label)``."""
    spark = rows.sparkSession
    known = materialize(usable(rows), "negatives-rows")
    # Ranges of equal lengths are split by the id, so that one common vector fills no task.
    by_length = known.repartitionByRange(F.col("norm2").desc(), F.xxhash64("vec_id"))
    buckets = materialize(by_length.select("vec_id", "label", "v").mapInArrow(_pack, _BUCKET), "negatives-buckets")
    out = None
    schema = "anchor long, positive long, vec_id long, score long"
    for block in _blocks(known.where(F.col("vec_id") % ANCHOR_MOD == 0)):
        shared = spark.sparkContext.broadcast(block)
        positives = _merged(buckets.mapInArrow(_positives(shared), schema), POSITIVES).drop("positive")
        positives = materialize(positives, "negatives-positives")
        # At most ``POSITIVES`` rows for each anchor of the block.
        found: list[list[tuple]] = [[] for _ in block]
        for r in positives.orderBy("anchor", "rank").collect():
            found[r["anchor"]].append((r["vec_id"], r["score"]))
        searched = spark.sparkContext.broadcast(
            [(*a, [s for _, s in p if s >= 0]) for a, p in zip(block, found)])
        best = _merged(buckets.mapInArrow(_negatives(searched), schema), NEGATIVES)
        ids = spark.createDataFrame([(n, a[0]) for n, a in enumerate(block)], "anchor long, anchor_id long")
        asked = positives.where("score >= 0").select(
            "anchor", (F.col("rank") - 1).cast("long").alias("positive"), F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"))
        mined = (best.join(asked, ["anchor", "positive"]).join(F.broadcast(ids), "anchor")
                 .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                         F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
        out = mined if out is None else out.unionByName(mined)
    return out if out is not None else spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
