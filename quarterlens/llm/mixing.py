"""Operator 5: mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to).  A flow network carries words from the patterns to the sources' quotas:
a pattern offers its size once per repetition, each further repetition at a
higher price per word (convex costs), up to ``MAX_REPEATS``; a source takes at
most its quota.  The cheapest largest flow says how many words each pattern
gives.  Inside a pattern every document is taken the whole number of times
that fits, and the rest goes, once more, to documents in a seeded hash order.

Only sums per pattern reach the driver; their number is that of distinct
source sets, not of documents.  The seeded order is cut by bucket sums: whole
hash buckets below the cut are in, and only the one bucket at the cut, of about
``BUCKET_DOCS`` documents, is walked in order, equal rows together.

Edge cases: a null source is a source of its own, last in order; a null or
blank text has size 0 and is taken 0 times; equal doc_ids hash alike but are
separate rows; no documents, or none with a word, give targets of 0; extra
columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.llm.common import materialize, n_words

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
BUCKET_DOCS = 2000
SEED = 42
BROADCAST_ROWS = 50_000


def targets_by_weight(sizes: dict, weights: dict, times: int = MAX_REPEATS) -> dict:
    """Share the total of ``sizes`` by weight; no target above ``times`` its size.

    What a capped source cannot take is shared anew among the others.
    """
    left = Fraction(sum(sizes.values()))
    out, free = {}, [s for s in sizes if weights[s] > 0]
    out.update({s: Fraction(0) for s in sizes if weights[s] <= 0})
    while free:
        total = sum(Fraction(weights[s]) for s in free)
        full = [s for s in free if left * weights[s] / total > times * sizes[s]]
        if not full:
            out.update({s: left * weights[s] / total for s in free})
            break
        for s in full:
            out[s] = Fraction(times * sizes[s])
        left -= sum(out[s] for s in full)
        free = [s for s in free if s not in out]
    return out


def min_cost_flow(supply: dict, quotas: dict, times: int = MAX_REPEATS) -> dict:
    """Words that each pattern (a tuple of sources) gives to each source.

    Cheapest among the largest flows from patterns to quotas, where the r-th
    repetition of a pattern costs 2r - 1 a word; successive shortest paths.
    """
    start, end = ("start",), ("end",)
    graph: dict = {}

    def edge(u, v, room, cost):
        a, b = [v, room, cost, None], [u, 0, -cost, None]
        a[3], b[3] = b, a
        graph.setdefault(u, []).append(a)
        graph.setdefault(v, []).append(b)
        return a

    for p, size in supply.items():
        for r in range(1, times + 1):
            edge(start, ("p", p), size, 2 * r - 1)
    given = {(p, s): edge(("p", p), ("s", s), times * size, 0)
             for p, size in supply.items() for s in p if s in quotas}
    for s, quota in quotas.items():
        edge(("s", s), end, quota, 0)
    while True:
        dist, via, todo = {start: 0}, {}, [start]
        for u in todo:  # label correcting; the queue grows while it is read
            for e in graph.get(u, []):
                if e[1] > 0 and dist[u] + e[2] < dist.get(e[0], 1 << 60):
                    dist[e[0]] = dist[u] + e[2]
                    via[e[0]] = e
                    todo.append(e[0])
        if end not in via:
            break
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = via[v][3][0]
        room = min(e[1] for e in path)
        for e in path:
            e[1] -= room
            e[3][1] += room
    return {k: e[3][1] for k, e in given.items() if e[3][1]}


def select_words(docs: DataFrame, flow: dict, totals: dict, counts: dict, seed: int = SEED) -> DataFrame:
    """Add ``taken`` to ``docs(doc_id, size, pattern, ...)``: words taken, repeats counted."""
    spark = docs.sparkSession
    give: dict = {}
    for (pattern, _), words in flow.items():
        give[pattern] = give.get(pattern, 0) + words
    rows = []
    for pattern, size in totals.items():
        whole, rest = divmod(give.get(pattern, 0), size) if size else (0, 0)
        rows.append((list(pattern), whole, rest, max(1, -(-counts[pattern] // BUCKET_DOCS))))
    plan = spark.createDataFrame(rows, "pattern array<string>, whole long, rest long, buckets long")
    if len(rows) <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    placed = (docs.join(plan, "pattern").withColumn("order", order)
              .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "order"), F.col("buckets"))))
    sums = placed.groupBy("pattern", "rest", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
           .select("pattern", "bucket", "before", "words"))
    placed = placed.join(cut, ["pattern", "bucket"])
    below = F.col("before") + F.col("words") <= F.col("rest")
    inside = (~below) & (F.col("before") < F.col("rest"))

    def walk(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("order", "doc_id", "size")])
        room, fits = rows["rest"][0].as_py() - rows["before"][0].as_py(), []
        for size, copies in zip(rows["size"].to_pylist(), rows["copies"].to_pylist()):
            fits.append(min(copies, room // size) if size else 0)
            room -= size * fits[-1]
        return rows.append_column("fits", pa.array(fits, pa.int64()))

    # Rows that hash alike because they are alike are walked as one row with a count.
    walked = placed.where(inside).groupBy(*placed.columns).agg(F.count("*").alias("copies"))
    schema = T.StructType([*walked.schema.fields, T.StructField("fits", T.LongType())])
    walked = (walked.groupBy("pattern", "bucket").applyInArrow(walk, schema)
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
              .withColumn("extra", (F.col("copy") <= F.col("fits")).cast("int")).drop("copy", "copies", "fits"))
    others = placed.where(~inside).withColumn("extra", below.cast("int"))
    return (others.unionByName(walked)
            .withColumn("taken", F.col("size") * (F.col("whole") + F.col("extra")))
            .select(*docs.columns, "taken"))


def mix_patterns(docs: DataFrame, targets, tag: str = "mixing") -> tuple[DataFrame, dict]:
    """Mix ``docs(doc_id, size, pattern)``; ``targets(sizes by source)`` gives the quotas.

    ``pattern`` is the sorted array of a document's sources; an overlapping
    document counts for each source in it.  Returns the documents with
    ``taken``, and (size, target) by source.
    """
    per = docs.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    totals = {tuple(r.pattern): r["size"] for r in per}
    counts = {tuple(r.pattern): r["n"] for r in per}
    sizes: dict = {}
    for pattern, size in totals.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + size
    quotas = targets(sizes)
    flow = min_cost_flow(totals, {s: int(q + Fraction(1, 2)) for s, q in quotas.items()})
    return select_words(docs, flow, totals, counts), {s: (sizes[s], quotas[s]) for s in sizes}


def mix_sources(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (and source) for ``docs(doc_id, text, source)``."""
    spark = docs.sparkSession
    # A letter in front tells the null source from every other and sorts it last.
    label = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("a"), F.col("source")))
    sized = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                    n_words(F.col("text")).alias("size"),
                                    F.array(label).alias("pattern")), "mixing-sizes")

    def by_weight(sizes):
        # "The total" is that of documents; with single sources it is that of the sources.
        weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(sorted(sizes))}
        return targets_by_weight(sizes, weights)

    mixed, plan = mix_patterns(sized, by_weight)
    rows = [(s, size, float(target)) for s, (size, target) in plan.items()]
    table = spark.createDataFrame(rows, "label string, source_size long, target double")
    if len(rows) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    return (mixed.withColumn("label", F.col("pattern")[0]).join(table, "label")
            .select("doc_id", "size", "source_size", "target", "taken",
                    F.when(F.col("label") != "n", F.expr("substr(label, 2)")).alias("source")))
