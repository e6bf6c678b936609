"""Operator 1: near-duplicate groups by an LSH forest over word shingles.

Every distinct shingle set is a node.  A forest of ``TREES`` independent
MinHash label sequences orders the nodes: each order is sorted by its labels
(range partitioning, then a sort inside the partitions), so nodes whose labels
share a long prefix stand together.  The longest-common-prefix neighbours of a
node are the rows before and after it; the depth of what they share, in single
labels from ``DEPTHS[0]`` up, adapts to how crowded its region is.  Nodes that
share their first labels up to one of ``DEPTHS`` are a run of the order.

Candidates come in four steps:

1. each node meets, of its neighbours in all sorted orders, the one with the
   deepest common prefixes in sum, and, of the heads of its runs, the one it
   shares most runs with.  This contracts copies and dense regions;
2. each node outside the largest component of one of its runs meets, of the
   members that stand for those components in its runs, the ``PICKS`` it shares
   most runs with;
3. each run that still spans several components, with at most ``MINORS`` nodes
   outside its largest one, has the pairs between them compared;
4. the nodes of the runs of the least depth that were more crowded, and still
   span several components, are joined exactly, however many they are.  A set's
   shingles are put in one order, rarest first; two similar sets share one of
   their first shingles (prefix filter), early enough in both for the overlap
   that their sizes ask for (position and length filter).  Pairs inside one
   component are never formed, so a group of copies costs nothing here.  The
   join is dealt by shingle, and a hot shingle by salts as well.

Steps 1 to 3 are linear in the number of nodes.  Step 4 is not cut: shingles
that many crowded nodes have among their rarest give as many pairs as they do.

Every link is confirmed on full shingle sets (64-bit hashes of the shingles).
At a similarity of exactly 0.75 two nodes share no run of depth 4 in any of
the 32 orders with probability 5e-6, and only then can their link be missed:
a shared run of depth 4 is compared in step 3 or joined in step 4.

Edge cases: a null, empty or blank text has an empty set and links with
nothing; rows with equal doc_id count as one document; a row with a null
doc_id is returned unlinked with a null component_id and kept; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.llm.common import Steps, materialize
from quarterlens.llm.components import connected_components
from quarterlens.llm.textkernel import mix, shingle_set, word_hashes

TREES = 32
DEPTHS = (4, 7, 12)
MINORS = 16
PICKS = 4
MIN_PERCENT = 75
#: Buckets of the shingle counts that order the sets of step 4; they shape its cost, not its result.
COUNT_BITS = 21
#: Nodes outside the largest component that a salt of a shingle takes.
SALT_NODES = 256


_RNG = np.random.default_rng(20240601)
_SHAPE = (TREES * DEPTHS[-1], 1)
_MUL = (_RNG.integers(0, 1 << 32, size=_SHAPE, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _RNG.integers(0, 1 << 32, size=_SHAPE, dtype=np.uint64).astype(np.uint32)
_TREE = np.arange(1, TREES + 1, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """(orders, depth) minima of the permuted shingle hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
    out = np.full(len(_MUL), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, x.shape[1], 2048):
        np.minimum(out, (_MUL * x[:, at:at + 2048] + _ADD).min(axis=1), out=out)
    return out.reshape(TREES, DEPTHS[-1])


def order_rows(sig: np.ndarray) -> np.ndarray:
    """(3, orders): what each order is sorted by, a hash of the first four labels and 16 bits of each of the others."""
    key = mix(_TREE)
    for depth in range(DEPTHS[0]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, depth].astype(np.uint64) + np.uint64(1))
    bits = mix(sig[:, DEPTHS[0]:].astype(np.uint64) + np.uint64(1)) >> np.uint64(48)
    packed = bits.reshape(TREES, -1, 4) << np.array([48, 32, 16, 0], dtype=np.uint64)
    return np.stack([key, *packed.sum(axis=2, dtype=np.uint64).T])


def run_keys(rows: np.ndarray) -> np.ndarray:
    """(len(DEPTHS), n) keys of the runs that (3, n) rows of the orders belong to, one per depth."""
    keys = [rows[0]]
    for depth in DEPTHS[1:]:
        left = 16 * (depth - DEPTHS[0])
        first = rows[1] >> np.uint64(max(64 - left, 0))
        second = rows[2] >> np.uint64(128 - left) if left > 64 else np.zeros_like(first)
        keys.append(mix(mix(rows[0] + np.uint64(depth)) ^ mix(first + np.uint64(depth)) * np.uint64(3) ^ mix(second)))
    return np.stack(keys)


def prefix_keys(sig: np.ndarray) -> np.ndarray:
    """(len(DEPTHS), orders) keys: one per order and prefix depth."""
    return run_keys(order_rows(sig))


def common_depths(rows: np.ndarray) -> np.ndarray:
    """How many first labels each of (3, n) sorted rows shares with the row before it; 0 if less than the least depth."""
    apart = rows[1:, 1:] ^ rows[1:, :-1]
    equal = sum((apart >> np.uint64(k) == 0).astype(np.int64) for k in (48, 32, 16, 0))
    deep = DEPTHS[0] + equal[0] + np.where(equal[0] == 4, equal[1], 0)
    return np.where(rows[0, 1:] == rows[0, :-1], deep, 0)


_ORDER = ["key", "r1", "r2"]
_PROFILE = ("doc_id long, n_shingles long, h1 long, h2 long, "
            + ", ".join(f"{k} array<long>" for k in _ORDER))


def _long_lists(rows: np.ndarray) -> pa.Array:
    """A list column from equally long rows."""
    n, width = rows.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1).view(np.int64)))


def _profiles(batches):
    for batch in batches:
        n, sums = [], []
        keys = np.zeros((len(_ORDER), batch.num_rows, TREES), dtype=np.uint64)
        for i, words in enumerate(word_hashes(batch.column(1))):
            s = shingle_set(words)
            n.append(len(s))
            sums.append((s.sum(dtype=np.uint64), mix(s + np.uint64(7)).sum(dtype=np.uint64)))
            if len(s):
                keys[:, i] = order_rows(signature(s))
        sums = np.array(sums, dtype=np.uint64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()),
             pa.array(sums[:, 0].copy().view(np.int64)), pa.array(sums[:, 1].copy().view(np.int64)),
             *map(_long_lists, keys)],
            names=["doc_id", "n_shingles", "h1", "h2", *_ORDER])


_KEYS = [f"k{d}" for d in DEPTHS]
_NEAR = ("node long, n long, " + ", ".join(f"{k} long" for k in _KEYS) + ", before long, before_n long, depth long")


def _neighbours(batches):
    """Of sorted rows (node, n, key, r1, r2) those that share a prefix with a row beside them.

    Each comes with the keys of the runs that it shares with such a row, and with the row before it.  The first and
    last row of a partition may have neighbours in another one, so they keep all their keys.
    """

    def kept(rows, depth_before, depth_after, before):
        deepest = np.maximum(depth_before, depth_after)
        keep = deepest >= DEPTHS[0]
        keys = run_keys(rows[2:, keep]).view(np.int64)
        columns = [pa.array(rows[i, keep].view(np.int64)) for i in (0, 1)]
        columns += [pa.array(k, mask=deepest[keep] < d) for k, d in zip(keys, DEPTHS)]
        alone = depth_before[keep] < DEPTHS[0]
        columns += [pa.array(before[i, keep].view(np.int64), mask=alone) for i in (0, 1)]
        columns.append(pa.array(np.where(alone, 0, depth_before[keep])))
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _NEAR.split(", ")])

    held = None  # the last row so far, which waits for the next: (row, depth shared with the one before, that one)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(5)])
        first = held is None
        if not first:
            rows = np.concatenate([held[0], rows], axis=1)
        depths = common_depths(rows[2:])
        # The first row of a partition counts as sharing all with what may stand before it, but has no row there.
        ahead = np.concatenate([[0] if first else [held[1]], depths])
        before = np.concatenate([rows[:2, :1] if first else held[2], rows[:2, :-1]], axis=1)
        shown = np.concatenate([depths, [0]])
        if first or held[3]:
            shown[0] = DEPTHS[-1]
        held = rows[:, -1:], ahead[-1], before[:, -1:], first and rows.shape[1] == 1
        yield kept(rows[:, :-1], ahead[:-1], shown[:-1], before[:, :-1])
    if held is not None:
        yield kept(held[0], np.array([held[1]]), np.array([DEPTHS[-1]]), held[2])


def _sets(batches):
    for batch in batches:
        sets = [shingle_set(words) for words in word_hashes(batch.column(1))]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.uint64), *sets])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
            names=["node", "shingles"])


def _shingle_rows(batch):
    """The sets of a batch of rows (node, n, shingles), in order."""
    column = batch.column(2)
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return np.split(flat, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))[:-1]


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _bucket_counts(batches):
    counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    for batch in batches:
        for shingles in _shingle_rows(batch):
            np.add.at(counts, _buckets(shingles), 1)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "count"])


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles, rarest first, of which each similar set has one among its own."""
    n = len(shingles)
    length = n + 1 - -(-n * MIN_PERCENT // 100)
    return shingles[np.lexsort((shingles, counts[_buckets(shingles)]))[:length]]


def _similar_sizes(a: str, b: str):
    return F.col(a) * 100 >= F.col(b) * MIN_PERCENT, F.col(b) * 100 >= F.col(a) * MIN_PERCENT


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    sa = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sa, "a").join(sb, "b")
            .withColumn("both", both)
            .where(F.col("both") * 100 >= (F.size("sa") + F.size("sb") - F.col("both")) * MIN_PERCENT)
            .select("a", "b"))


def _deepest(orders: DataFrame) -> DataFrame:
    """Step 1: for each node the neighbour, in all sorted orders, with the deepest common prefixes in sum."""
    near, far = _similar_sizes("n", "before_n")
    met = orders.where("depth > 0 and node != before").where(near & far).groupBy("node", "before") \
        .agg(F.sum("depth").alias("depth"))
    both = met.unionByName(met.select(F.col("before").alias("node"), F.col("node").alias("before"), "depth"))
    return (both.groupBy("node").agg(F.max(F.struct("depth", -F.col("before"))).alias("best"))
            .select(F.col("node").alias("a"), (-F.col("best.col2")).alias("b")))


def _heads(runs: DataFrame) -> DataFrame:
    """Step 1: for each node the head that it shares most runs with."""
    head = runs.groupBy("key").agg(F.min(F.struct("node", "n")).alias("head"))
    met = runs.join(head, "key").select("node", "n", F.col("head.node").alias("head"), F.col("head.n").alias("head_n"))
    near, far = _similar_sizes("n", "head_n")
    return (met.where(F.col("head") != F.col("node")).where(near & far)
            .groupBy("node", "head").count()
            .groupBy("node").agg(F.max(F.struct("count", -F.col("head"))).alias("best"))
            .select(F.col("node").alias("a"), (-F.col("best.col2")).alias("b")))


def _regions(runs: DataFrame, key: str) -> DataFrame:
    """The runs that span several components: key, largest component, nodes outside it."""
    per = runs.groupBy(key, "component").agg(F.count("*").alias("size"))
    return (per.groupBy(key).agg(F.sum("size").alias("all"), F.count("*").alias("parts"),
                                 F.max(F.struct("size", "component")).alias("major"))
            .where("parts > 1")
            .select(key, F.col("major.component").alias("major"),
                    (F.col("all") - F.col("major.size")).alias("minors")))


def _outsiders(spread: DataFrame) -> DataFrame:
    """Step 2: nodes outside a run's largest component, with members of it."""
    # Any member will do, but not the head that step 1 has tried.
    picks = (spread.where("component = major").groupBy("key")
             .agg(F.min(F.struct(F.xxhash64("node"), "node", "n")).alias("pick")))
    met = (spread.where("component != major").join(picks, "key")
           .select("node", "n", F.col("pick.node").alias("pick"), F.col("pick.n").alias("pick_n")))
    near, far = _similar_sizes("n", "pick_n")
    best = Window.partitionBy("node").orderBy(F.col("count").desc(), "pick")
    return (met.where(near & far).groupBy("node", "pick").count()
            .withColumn("place", F.row_number().over(best)).where(F.col("place") <= PICKS)
            .select(F.col("node").alias("a"), F.col("pick").alias("b")))


def _between(spread: DataFrame) -> DataFrame:
    """Step 3: the pairs of nodes of one run but of different components, of similar sizes."""
    ready = spread.where(F.col("minors") <= MINORS)
    minor = (ready.where("component != major")
             .select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca")))
    near, far = _similar_sizes("na", "n")
    return (minor.join(ready, "key")
            .where((F.col("component") != F.col("ca")) & near & far
                   & ((F.col("component") == F.col("major")) | (F.col("a") < F.col("node"))))
            .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())


def _rarest_first(dense: DataFrame) -> DataFrame:
    """The prefixes of the sets of ``dense(node, n, shingles)`` as rows (node, n, place, shingle)."""
    spark = dense.sparkSession
    found = (dense.mapInArrow(_bucket_counts, "bucket long, count long")
             .groupBy("bucket").agg(F.sum("count").alias("count")).toArrow())
    counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("count").to_numpy()
    shared = spark.sparkContext.broadcast(counts)

    def prefixes(batches):
        for batch in batches:
            sets = [prefix(s, shared.value) for s in _shingle_rows(batch)]
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            which = pa.array(np.repeat(np.arange(len(sets)), sizes))
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), batch.column(1).take(which), pa.array(place), pa.array(flat)],
                names=["node", "n", "place", "shingle"])

    return dense.mapInArrow(prefixes, "node long, n long, place long, shingle long")


def _exact(dense: DataFrame, found: DataFrame) -> DataFrame:
    """Step 4: every pair of nodes of ``dense(node, n, shingles)`` that may be similar, of different components."""
    rows = materialize(_with_components(_rarest_first(dense), found, "place", "shingle"), "dedup-prefixes")
    spread = rows.join(_regions(rows, "shingle"), "shingle").withColumn("salts", F.ceil(F.col("minors") / SALT_NODES))
    ours = (spread.where("component != major")
            .select("shingle", F.pmod(F.xxhash64("node"), "salts").alias("salt"), F.col("node").alias("a"),
                    F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca")))
    theirs = (spread.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
              .select("shingle", "salt", "node", "n", "place", "component", "major"))
    # The first shingle that two sets share leaves room for the whole overlap that similarity asks for.
    need = (F.col("na") + F.col("n")) * MIN_PERCENT
    room = F.least(F.col("na") - F.col("pa"), F.col("n") - F.col("place")) * (100 + MIN_PERCENT)
    return (ours.join(theirs, ["shingle", "salt"])
            .where((F.col("component") != F.col("ca")) & (room >= need)
                   & ((F.col("component") == F.col("major")) | (F.col("a") < F.col("node"))))
            .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())


def _with_components(runs: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """``runs`` with each node's component, itself where none was found."""
    return (runs.join(found.withColumnRenamed("component", "c"), "node", "left")
            .select("node", "n", *keys, F.coalesce("c", "node").alias("component")))


def _contracted(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found(node, component)`` merged along further links (a, b)."""
    of = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    links = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
             .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    merged = connected_components(links, "dedup-cc")
    top = merged.select(F.col("node").alias("component"), F.col("component").alias("top"))
    old = found.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    new = merged.join(found.select("node"), "node", "left_anti").select("node", "component")
    return materialize(old.unionByName(new), "dedup-found")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs(doc_id, text)``."""
    steps = Steps(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profiles = steps.write(docs.mapInArrow(_profiles, _PROFILE), "dedup-profiles")
    classes = ["h1", "h2", "n_shingles"]
    ids = materialize(profiles.select("doc_id", *classes), "dedup-ids")
    has_set = "n_shingles > 0 and doc_id is not null"
    classes_nodes = materialize(ids.where(has_set).groupBy(*classes).agg(F.min("doc_id").alias("node")), "dedup-nodes")
    keys = profiles.where(has_set).groupBy(*classes).agg(
        F.min("doc_id").alias("node"), *(F.any_value(k).alias(k) for k in _ORDER))
    # One row for each node and order.  The node is a part of the sort, so a region of equal labels can be split.
    rows = keys.select("node", F.col("n_shingles").alias("n"), F.inline(F.arrays_zip(*_ORDER)))
    orders = steps.write(rows.repartitionByRange(*_ORDER, "node").sortWithinPartitions(*_ORDER, "node")
                         .mapInArrow(_neighbours, _NEAR), "dedup-orders")
    steps.drop(profiles)
    # One row for each node and run; a run that one node alone has leads nowhere.
    depths = F.array(*(F.struct(F.col(k).alias("key"), F.lit(k == _KEYS[0]).alias("shallow")) for k in _KEYS))
    runs = orders.select("node", "n", F.inline(depths)).where("key is not null")
    sets = steps.write(
        docs.join(orders.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .mapInArrow(_sets, "node long, shingles array<long>"), "dedup-sets")

    def spread() -> DataFrame:
        """The rows of the runs that span several of the components found so far."""
        parts = _with_components(runs, found, "key", "shallow")
        return steps.write(parts.join(_regions(parts, "key"), "key"), "dedup-spread")

    found = connected_components(_verified(_heads(runs).unionByName(_deepest(orders)).distinct(), sets), "dedup-cc")
    some = spread()
    found = _contracted(found, _verified(_outsiders(some), sets))
    steps.drop(some)
    some = spread()
    found = _contracted(found, _verified(_between(some), sets))
    # The crowded runs of the least depth, if they still span several components.
    crowded = _with_components(some.where(F.col("shallow") & (F.col("minors") > MINORS)).drop("component"), found, "key")
    dense = steps.write(crowded.join(_regions(crowded, "key"), "key", "left_semi").select("node", "n").distinct(),
                        "dedup-dense")
    steps.drop(orders, some)
    if not dense.isEmpty():
        dense_sets = steps.write(sets.join(dense, "node").select("node", "n", "shingles"), "dedup-dense-sets")
        steps.drop(sets)
        tried = steps.write(_exact(dense_sets, found), "dedup-exact")
        found = _contracted(found, _verified(tried, dense_sets))
        steps.drop(dense_sets, tried)
    else:
        steps.drop(sets)
    steps.drop(dense)
    of_class = (classes_nodes.join(found, "node", "left")
                .select(*classes, F.coalesce("component", "node").alias("component_id")))
    linked = ids.where(has_set).join(of_class, classes)
    alone = ids.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their group, all columns as given.

    Of rows with equal doc_id the smallest stays; rows without a doc_id stay.
    """
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    stay = (docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
            .groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", "row.*"))
    return stay.select(*docs.columns).unionByName(docs.where("doc_id is null"))
