"""Operator 3: approximate nearest neighbours on robust-pruned directed graphs.

Nearness is the inner product.  Equal vectors are one node.  The nodes are
dealt to shards of at most about ``SHARD`` nodes by their norm's band of
``BAND`` powers of two, so that no vector flattens the others of its shard, and
by a hash; each shard builds a graph:
nodes are inserted in growing batches, a greedy beam search in the graph so
far proposes neighbours, and relaxed distance pruning keeps a candidate only
if no nearer kept one is ``ALPHA`` times nearer to it.  Kept edges are also
added in reverse and pruned again where a node has more than ``DEGREE``.
Within a shard the inner product is turned into a distance by one more
coordinate that gives all vectors the same length, in double precision after
scaling by a power of two; norms of any finite size take part.

Every query beam-searches every shard (in blocks of ``QUERY_BLOCK`` queries)
and the shards' best are merged.  A graph moves once per block, so a block is
as many queries as fit a task.  Reported scores are computed anew in double
precision on the original vectors.  Work is the number of queries times the
number of shards times about the logarithm of a shard.

A group of equal vectors of any size is exact: its ``k`` + 1 smallest ids are
all that a result of ``k`` rows can show.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, as queries or candidates, nor does a row with a null
vec_id; vectors of another length are not compared; repeated rows count once;
fewer than ``k`` candidates give fewer rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.llm.common import materialize

SHARD = 16384
BAND = 3
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
WIDTH = 4
ALPHA = 1.2
BATCH = 512
QUERY_BLOCK = 32768
K = 20
QUERY_MOD = 20


def beam_search(points: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int):
    """(ids, inner products) of the ``beam`` best points found for each query, best first; id -1: none."""
    n, b = len(points), len(queries)
    ids = np.full((b, beam), -1, dtype=np.int32)
    near = np.full((b, beam), -np.inf, dtype=np.float32)
    done = np.ones((b, beam), dtype=bool)
    seen = np.zeros((b, n + 1), dtype=bool)
    seen[:, n] = True  # where padding points to
    ids[:, 0], near[:, 0], done[:, 0] = entry, queries @ points[entry], False
    seen[:, entry] = True
    active = np.arange(b)
    while len(active):
        open_ = ~done[active]
        rank = np.cumsum(open_, axis=1)
        take = open_ & (rank <= WIDTH)
        has = rank[:, -1] > 0
        active, take, rank = active[has], take[has], rank[has]
        if not len(active):
            break
        row, col = np.nonzero(take)
        new = np.full((len(active), WIDTH, graph.shape[1]), -1, dtype=np.int32)
        new[row, rank[row, col] - 1] = graph[ids[active[row], col]]
        done[active[row], col] = True
        new = new.reshape(len(active), -1)
        new = np.where(new < 0, n, new)
        who = np.broadcast_to(active[:, None], new.shape)
        new[seen[who, new]] = n
        seen[who, new] = True
        new.sort(axis=1)  # the expanded nodes may share neighbours
        new[:, 1:][new[:, 1:] == new[:, :-1]] = n
        r, c = np.nonzero(new < n)
        score = np.full(new.shape, -np.inf, dtype=np.float32)
        score[r, c] = np.einsum("ij,ij->i", points[new[r, c]], queries[active[r]])
        all_ids = np.concatenate([ids[active], np.where(new == n, -1, new)], axis=1)
        all_near = np.concatenate([near[active], score], axis=1)
        all_done = np.concatenate([done[active], new == n], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, best, 1)
        near[active] = np.take_along_axis(all_near, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1)
    return ids, near


def robust_prune(points: np.ndarray, at: np.ndarray, candidates: np.ndarray, length2: float) -> np.ndarray:
    """(len(at), DEGREE) neighbours kept of the candidates (-1: none) of the points ``at``."""
    valid = (candidates >= 0) & (candidates != at[:, None])
    safe = np.where(valid, candidates, 0)
    around = points[safe]
    far = np.where(valid, length2 - np.einsum("bcd,bd->bc", around, points[at]), np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    far, safe = np.take_along_axis(far, order, 1), np.take_along_axis(safe, order, 1)
    around = points[safe]
    between = length2 - np.matmul(around, around.transpose(0, 2, 1))
    alive = np.isfinite(far)
    out = np.full((len(at), DEGREE), -1, dtype=np.int32)
    rows = np.arange(len(at))
    for k in range(DEGREE):
        j = alive.argmax(axis=1)
        has = alive[rows, j]
        if not has.any():
            break
        out[has, k] = safe[rows[has], j[has]]
        # Squared distances: the relaxation counts twice.
        alive &= ~((ALPHA * ALPHA * between[rows, j] <= far) & has[:, None])
        alive[rows, j] = False
    return out


def build_graph(vectors: np.ndarray, seed: int = 7):
    """(points of equal length, neighbour lists padded with -1, entry point) of a shard."""
    x = vectors.astype(np.float64)
    x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))
    norm2 = np.einsum("ij,ij->i", x, x)
    length2 = float(norm2.max())
    points = np.concatenate([x, np.sqrt(np.maximum(length2 - norm2, 0))[:, None]], axis=1)
    points = (points / (np.sqrt(length2) or 1)).astype(np.float32)
    n = len(points)
    entry = int((points @ points.mean(axis=0)).argmax())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    graph = np.full((n, DEGREE), -1, dtype=np.int32)
    degree = np.zeros(n, dtype=np.int64)
    done = 1
    while done < n:
        batch = order[done:done + min(BATCH, max(1, done))]
        found = [beam_search(points, graph, entry, points[part], BUILD_BEAM)[0]
                 for part in np.array_split(batch, -(-len(batch) // 256))]
        kept = robust_prune(points, batch, np.concatenate(found), 1.0)
        graph[batch] = kept
        degree[batch] = (kept >= 0).sum(axis=1)
        r, c = np.nonzero(kept >= 0)
        _reverse(points, graph, degree, kept[r, c], batch[r])
        done += len(batch)
    return points, graph, entry


def _reverse(points, graph, degree, targets, sources):
    """Add edges targets -> sources; prune the nodes that get too many."""
    order = np.argsort(targets, kind="stable")
    targets, sources = targets[order], sources[order]
    nodes, first, count = np.unique(targets, return_index=True, return_counts=True)
    for at in range(0, len(nodes), 256):
        some, begin, size = nodes[at:at + 256], first[at:at + 256], count[at:at + 256]
        width = int(size.max())
        place = np.arange(width)[None, :]
        new = np.where(place < size[:, None], sources[np.minimum(begin[:, None] + place, len(sources) - 1)], -1)
        fits = degree[some] + size <= DEGREE
        for node, row, k in zip(some[fits], new[fits], size[fits]):
            graph[node, degree[node]:degree[node] + k] = row[:k]
            degree[node] += k
        over = some[~fits]
        if len(over):
            # Of very many reverse edges the nearest decide; the others would be pruned by them.
            more = new[~fits]
            if width > 2 * DEGREE:
                close = np.where(more >= 0, np.einsum("bcd,bd->bc", points[np.maximum(more, 0)], points[over]), -np.inf)
                more = np.take_along_axis(more, np.argsort(-close, axis=1)[:, :2 * DEGREE], 1)
            graph[over] = robust_prune(points, over, np.concatenate([graph[over], more], axis=1), 1.0)
            degree[over] = (graph[over] >= 0).sum(axis=1)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


_GRAPH = ("dim long, shard long, reps binary, vectors binary, wide boolean, points binary, graph binary, entry long")


def _build_shard(table: pa.Table) -> pa.Table:
    dim = table.column("dim")[0].as_py()
    table = table.sort_by("rep")
    vectors = _matrix(table.column("embedding"), dim)
    points, graph, entry = build_graph(vectors)
    row = {"dim": dim, "shard": table.column("shard")[0].as_py(),
           "reps": table.column("rep").to_numpy().astype(np.int64).tobytes(), "vectors": vectors.tobytes(),
           "wide": vectors.dtype == np.float64, "points": points.astype(np.float32).tobytes(),
           "graph": graph.tobytes(), "entry": entry}
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.Table.from_pylist([row], schema=pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _GRAPH.split(", ")]))


def _search_shard(k: int):
    def search(queries: pa.Table, shards: pa.Table) -> pa.Table:
        ids, reps, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if queries.num_rows and shards.num_rows:
            s = {c: shards.column(c)[0].as_py() for c in shards.column_names}
            dim = s["dim"]
            rep = np.frombuffer(s["reps"], np.int64)
            exact = np.frombuffer(s["vectors"], np.float64 if s["wide"] else np.float32).reshape(-1, dim)
            points = np.frombuffer(s["points"], np.float32).reshape(-1, dim + 1)
            graph = np.frombuffer(s["graph"], np.int32).reshape(-1, DEGREE)
            vectors, query = _matrix(queries.column("embedding"), dim), queries.column("query_id").to_numpy()
            for at in range(0, len(query), 256):
                q = vectors[at:at + 256].astype(np.float64)
                unit = np.zeros((len(q), dim + 1), dtype=np.float32)
                unit[:, :dim] = q / np.abs(q).max(axis=1, keepdims=True)
                found, _ = beam_search(points, graph, s["entry"], unit, SEARCH_BEAM)
                found = found[:, :2 * k + 24]
                score = np.einsum("bcd,bd->bc", exact[np.maximum(found, 0)].astype(np.float64), q)
                score = np.where(found >= 0, score, -np.inf)
                best = np.lexsort((rep[np.maximum(found, 0)], -score), axis=1)[:, :k + 1]
                found, score = np.take_along_axis(found, best, 1), np.take_along_axis(score, best, 1)
                r, c = np.nonzero(found >= 0)
                ids.append(query[at + r])
                reps.append(rep[found[r, c]])
                scores.append(score[r, c])
        return pa.table({"query_id": np.concatenate(ids), "rep": np.concatenate(reps), "score": np.concatenate(scores)})

    return search


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding, dim) of the rows that take part, each once."""
    kind = "array<float>" if "float" in embeddings.schema["embedding"].dataType.simpleString() else "array<double>"
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))
                   & F.exists("embedding", lambda v: v != 0))
            .withColumn("dim", F.size("embedding").cast("long")).distinct())


def _band():
    """The band of a vector's norm, without overflow."""
    most = F.array_max(F.transform("embedding", lambda v: F.abs(v.cast("double"))))
    rest = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + F.pow(v.cast("double") / most, F.lit(2.0)))
    return F.floor((F.log2(most) + F.log2(rest) / 2) / BAND + 0.5).cast("long").alias("band")


def nearest(embeddings: DataFrame, k: int = K, query_mod: int = QUERY_MOD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query (vec_id divisible by ``query_mod``)."""
    valid = materialize(valid_vectors(embeddings), "ann-valid")
    smallest = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    classes = materialize(
        valid.withColumn("place", smallest).where(F.col("place") <= k + 1)
        .groupBy("embedding", "dim").agg(F.min("vec_id").alias("rep"), F.collect_list("vec_id").alias("members")),
        "ann-classes")
    queries = valid.where(F.col("vec_id") % query_mod == 0)
    tasks = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes_in = classes.select("dim", "rep", "embedding", _band())
    # A row per vector length and band, of which there are at most some hundreds.
    bands = classes_in.groupBy("dim", "band").agg(F.ceil(F.count("*") / SHARD).cast("long").alias("parts"))
    before = Window.partitionBy("dim").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumn("first", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("long"))
    per = bands.groupBy("dim").agg(F.sum("parts").cast("long").alias("shards"))
    asked = queries.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("long").alias("blocks"))
    sizes = per.join(asked, "dim", "left")  # a row per vector length
    deal = lambda c, n: F.pmod(F.xxhash64(c, F.lit(3)), F.col(n))
    graphs = materialize(
        classes_in.join(bands, ["dim", "band"])
        .select("dim", (F.col("first") + deal("rep", "parts")).alias("shard"), "rep", "embedding")
        # By number: adaptive execution would put many shards, small in bytes, into one task.
        .repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInArrow(_build_shard, _GRAPH), "ann-graphs")
    here = (graphs.join(sizes, "dim").where("blocks is not null")
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("shards", "blocks"))
    there = (queries.join(sizes, "dim")
             .select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"),
                     deal("vec_id", "blocks").alias("block"), F.col("vec_id").alias("query_id"), "embedding"))
    keys = ["dim", "shard", "block"]
    found = (there.repartition(tasks, *keys).groupBy(*keys).cogroup(here.repartition(tasks, *keys).groupBy(*keys))
             .applyInArrow(_search_shard(k), "query_id long, rep long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.join(classes.select("rep", "members"), "rep")
            .select("query_id", F.explode("members").alias("vec_id"), "score")
            .where("vec_id != query_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
