"""Operator 7: a quality classifier made of sparse rules over text statistics.

Each text becomes a row of statistics (``STATISTICS``).  Shallow boosted trees
are grown on a labelled sample; every path from a root to a node is a rule, a
conjunction of thresholds.  A lasso logistic regression over the rules gives
most of them weight 0; the rest are compiled into one Spark column expression
over the statistics, so the model that scores is readable SQL.

Learning reads at most ``TRAIN_ROWS`` distinct (doc_id, label), chosen by a
hash of doc_id, and one text of each, the smallest; only their statistics reach
the driver, so at most ``TRAIN_ROWS`` rows.  Every text is scored whole.

Edge cases: null and empty texts have statistics of 0 and are scored by the
same rules; rows with a null doc_id are scored, not held out and not learned
from; several labels of one doc_id all count; a null label is not learned;
without labels of both kinds the score is the share of label 1 (0.5 without
any); repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlens.llm.textkernel import shingle_set, string_buffers, word_hashes

TRAIN_ROWS = 10_000
HELD_OUT_MOD, HELD_OUT_REST = 4, 2
TREES, DEPTH, SHRINK, BINS, LEAST_LEAF = 40, 3, 0.3, 32, 20
LASSO = 2e-3
THRESHOLD = 0.7

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digit", "symbol", "point", "bar", "space", "newline",
    "wide", "distinct_words", "top_word", "same_next", "distinct_shingles", "distinct_lines", "line_words", "stop_marks")
_UPPER, _DIGIT = list(range(65, 91)), list(range(48, 58))
_SYMBOL, _POINT = [ord(c) for c in "#$%&*@^~=+<>{}[]\\/_"], [ord(c) for c in "!?"]
_CLASSES = np.zeros((256, 8))
for _i, _members in enumerate((_UPPER, _DIGIT, _SYMBOL, _POINT, [ord("|")], [9, 11, 12, 13, 32], [10],
                               list(range(128, 192)))):
    _CLASSES[_members, _i] = 1


def statistics(column: pa.Array) -> np.ndarray:
    """(texts, len(STATISTICS)) of a string column."""
    data, offsets = string_buffers(column)
    out = np.zeros((len(column), len(STATISTICS)))
    for i, words in enumerate(word_hashes(column)):
        text = data[offsets[i]:offsets[i + 1]]
        size, n = len(text), len(words)
        if not n:
            continue
        kinds = np.bincount(text, minlength=256) @ _CLASSES
        counts = np.unique(words, return_counts=True)[1]
        shingles = max(n - 4, 1)
        raw = text.tobytes()
        lines = [x for x in raw.split(b"\n") if x]
        out[i] = (np.log(size), np.log(n), (size - kinds[5] - kinds[6]) / n, *(kinds[:8] / size),
                  len(counts) / n, counts.max() / n, np.count_nonzero(words[1:] == words[:-1]) / n,
                  len(shingle_set(words)) / shingles, len(set(lines)) / max(len(lines), 1),
                  n / max(len(lines), 1), (raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".")) / n)
    return out


def grow_tree(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int = DEPTH):
    """Paths of one regression tree on binned statistics.

    Returns (rules, step): a rule is a tuple of (statistic, bin, goes above),
    and step is what the tree adds to every row.
    """
    rules, step = [], np.zeros(len(bins))

    def split(rows, path):
        g, h = gradient[rows].sum(), hessian[rows].sum()
        best = (1e-6, None)
        if len(path) < depth and len(rows) >= 2 * LEAST_LEAF:
            for j in range(bins.shape[1]):
                at = bins[rows, j]
                gl = np.cumsum(np.bincount(at, gradient[rows], BINS))[:-1]
                hl = np.cumsum(np.bincount(at, hessian[rows], BINS))[:-1]
                nl = np.cumsum(np.bincount(at, minlength=BINS))[:-1]
                gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1)
                gain[(nl < LEAST_LEAF) | (len(rows) - nl < LEAST_LEAF)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, k))
        if best[1] is None:
            step[rows] = -SHRINK * g / (h + 1)
            return
        j, k = best[1]
        for above in (False, True):
            side = rows[(bins[rows, j] > k) == above]
            rules.append(path + ((j, k, above),))
            split(side, path + ((j, k, above),))

    split(np.arange(len(bins)), ())
    return rules, step


def _fires(bins: np.ndarray, rule) -> np.ndarray:
    out = np.ones(len(bins), dtype=bool)
    for j, k, above in rule:
        out &= (bins[:, j] > k) == above
    return out


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float = LASSO, rounds: int = 600):
    """(intercept, weights) by accelerated proximal gradient steps on standardised columns."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = (x - mean) / scale
    step = 4 / max(np.linalg.norm(z, 2) ** 2 / len(z) + 1, 1e-9)
    w, b, v, c, t = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        w2 = v - step * (z.T @ error) / len(z)
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - step * penalty, 0)
        b2 = c - step * error.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    w = w / scale
    return b - w @ mean, w


def fit_rules(x: np.ndarray, y: np.ndarray):
    """(intercept, [(weight, ((statistic, threshold, above), ...)), ...]) from statistics and 0/1 labels."""
    rate = y.mean() if len(y) else 0.5
    if not len(y) or not 0 < rate < 1:
        return rate, None
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    margin, rules = np.full(len(y), np.log(rate / (1 - rate))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        found, step = grow_tree(bins, p - y, p * (1 - p))
        margin += step
        rules.update({tuple(sorted(r)): None for r in found})
    rules = [r for r in rules if 0 < _fires(bins, r).mean() < 1]
    if not rules:
        return rate, None
    fired = np.stack([_fires(bins, r) for r in rules], axis=1).astype(float)
    intercept, weights = lasso_logistic(fired, y)
    return intercept, [(w, tuple((STATISTICS[j], float(cuts[j][k]), above) for j, k, above in r))
                       for w, r in zip(weights, rules) if abs(w) > 1e-9]


def compile_rules(intercept: float, rules) -> Column:
    """The score of a row of statistics as a column expression."""
    if rules is None:
        return F.lit(float(intercept))
    parts = []
    for weight, rule in rules:
        test = F.lit(True)
        for name, cut, above in rule:
            test = test & (F.col(name) > cut if above else F.col(name) <= cut)
        parts.append(F.when(test, F.lit(float(weight))).otherwise(F.lit(0.0)))
    total = F.aggregate(F.array(*parts), F.lit(float(intercept)), lambda a, b: a + b) if parts else F.lit(float(intercept))
    return 1 / (1 + F.exp(-total))


_SCHEMA = "doc_id long, held_out boolean, label double, " + ", ".join(f"{s} double" for s in STATISTICS)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, label and the statistics of ``docs(doc_id, text, label)``."""

    def count(batches):
        for batch in batches:
            stats = statistics(batch.column(3))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), *(pa.array(stats[:, j]) for j in range(len(STATISTICS)))],
                names=["doc_id", "held_out", "label", *STATISTICS])

    return docs.select("doc_id", "held_out", "label", "text").mapInArrow(count, _SCHEMA)


def _held_out():
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_MOD
    return F.coalesce(remainder == HELD_OUT_REST, F.lit(False))


def train(docs: DataFrame, labels: DataFrame):
    """Rules learned from the rows of ``labels(doc_id, quality)`` that are not held out."""
    spark = docs.sparkSession
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
           .where("doc_id is not null and label is not null").where(~_held_out()).distinct()
           .orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id", "label").limit(TRAIN_ROWS).collect())
    if not ids:
        return 0.5, None
    chosen = spark.createDataFrame([tuple(r) for r in ids], "doc_id long, label double")
    # Of rows that share doc_id one is learned for each label, however many there are.
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id", "label").agg(F.min("text").alias("text")).withColumn("held_out", F.lit(False)))
    rows = describe(sample).drop("held_out").toPandas().sort_values(["doc_id", "label"], kind="stable")
    return fit_rules(rows[list(STATISTICS)].to_numpy(), rows["label"].to_numpy())


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    score = compile_rules(*train(docs, labels))
    stats = describe(docs.withColumn("held_out", _held_out()).withColumn("label", F.lit(None).cast("double")))
    return (stats.withColumn("score", score)
            .select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
