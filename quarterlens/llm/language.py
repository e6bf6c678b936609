"""Operator 4: language identification by a blended-spectrum string kernel.

A text is lower-cased, everything but letters becomes a space, and the set of
its byte n-grams for n = 1 to 3 is its feature set.  The kernel of two texts is
the number of n-grams they share over the geometric mean of their set sizes.
Landmark texts approximate it (Nystroem): their n-grams form the vocabulary,
a text is described by its kernel with every landmark, and one-versus-rest
kernel ridge regression in that space gives a margin per language:

    (K_nm' K_nm + ridge K_mm) a = K_nm' y,   y = +1 or -1.

Texts are scored in blocks: one presence matrix, two matrix products.

Learning reads at most ``TRAIN_PER_LANG`` texts per language, chosen by a hash
of doc_id; ``LANDMARKS_PER_LANG`` of them are landmarks.  The sample's n-gram
sets and kernel rows, not its texts, reach the driver.  Every text is scored
whole, long ones in pieces that overlap by two bytes.

``known_language`` keeps the texts that some learned language claims.  What
claims a text is calibrated when the model is fitted, on fragments of the
sample's texts that are no landmarks, each scored by a model that was fitted
without its half of them.  A language claims a text whose margin is at least
where the errors are equal: as large a share of the languages' own fragments
stays under it as of the other languages' fragments reaches it.  And a text has
to know its trigrams: at least ``LEAST_SHARE`` of the share that all but
``TAIL`` of the fragments know, so that other scripts and letter soup go, to
which no margin means anything.  The fragments' lengths run from ``FRAGMENTS``
bytes up, all counted alike, so no size of a text has a rule of its own.  A
text is judged together with ``PRIOR`` more trigrams that are known and speak
neither for nor against it: a text of a few words shows little and stays.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and
so is every text if nothing could be learned; rows with a null doc_id are
scored but not learned from, and not held out; a null lang is not learned;
repeated rows give repeated results, and of rows with equal doc_id and lang the
smallest text alone is learned; extra columns are ignored by ``identify`` and
kept by ``known_language``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.llm.textkernel import string_buffers

TRAIN_PER_LANG = 400
LANDMARKS_PER_LANG = 40
RIDGE = 1e-2
HELD_OUT_MOD = 5
FRAGMENTS = (16, 32, 64, 128, 256, 1024, 4096)
TAIL, LEAST_SHARE, PRIOR = 0.01, 0.5, 16
BLOCK = 1 << 19
BLOCK_ROWS = 256
#: Codes of n-grams: three bytes, then two, then one.
_TWO, _ONE, _CODES = 1 << 24, (1 << 24) + (1 << 16), (1 << 24) + (1 << 16) + 256


def _letters_only(data: np.ndarray) -> np.ndarray:
    keep = ((data >= 97) & (data <= 122)) | (data >= 128)
    return np.where(keep, data, 32).astype(np.int32)


def _codes(data: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(codes, n) of the n-grams that begin at each byte."""
    yield data + _ONE, 1
    if len(data) > 1:
        two = data[:-1] << 8 | data[1:]
        yield two + _TWO, 2
        if len(data) > 2:
            yield two[:-1] << 8 | data[2:], 3


def gram_set(data: np.ndarray) -> np.ndarray:
    """Sorted distinct n-gram codes of one text's bytes."""
    grams = np.zeros(0, np.int32)
    for at in range(0, max(len(data), 1), BLOCK):
        piece = _letters_only(data[at:at + BLOCK + 2])
        found = [np.unique(c) for c, _ in _codes(piece)]
        grams = np.unique(np.concatenate([grams, *found])) if len(piece) else grams
    return grams


def blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded bytes and rows."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1
        stop = max(row + 1, min(stop, row + BLOCK_ROWS, n))
        yield row, stop
        row = stop


class Kernel:
    """Kernel rows of texts against landmark n-gram sets."""

    def __init__(self, landmarks: list[np.ndarray]):
        self.vocabulary = np.unique(np.concatenate(landmarks))
        self.table = np.full(_CODES, -1, dtype=np.int32)
        self.table[self.vocabulary] = np.arange(len(self.vocabulary))
        self.members = np.zeros((len(self.vocabulary), len(landmarks)), dtype=np.float32)
        for j, grams in enumerate(landmarks):
            self.members[self.table[grams], j] = 1 / np.sqrt(len(grams))

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, landmarks) kernel values of a block of texts."""
        return self.rows_and_trigrams(data, offsets)[0]

    def rows_and_trigrams(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(texts, landmarks) kernel values of a block of texts, and the known and all trigrams of each."""
        n, width = len(offsets) - 1, len(self.vocabulary)
        present = np.zeros((n, width + 1), dtype=np.float32)  # the last column takes unknown n-grams
        flat = present.reshape(-1)
        found, total = np.zeros(n), np.zeros(n)
        first, end = int(offsets[0]), int(offsets[-1])
        for at in range(first, end, BLOCK):
            upto = min(at + BLOCK + 2, end)
            piece = _letters_only(data[at:upto])
            begins = np.arange(at, upto)
            row = np.searchsorted(offsets, begins, "right") - 1
            left = offsets[row + 1] - begins  # bytes of the text from here on
            for codes, size in _codes(piece):
                fits = left[:len(codes)] >= size
                text, at_gram = row[:len(codes)][fits], self.table[codes[fits]]
                flat[text * (width + 1) + at_gram % (width + 1)] = 1
                if size == 3:
                    found += np.bincount(text[at_gram >= 0], minlength=n)
                    total += np.bincount(text, minlength=n)
        known = present[:, :width]
        size = np.sqrt(np.maximum(known.sum(axis=1, keepdims=True), 1))
        return known @ self.members / size, found, total

    def of_sets(self, sets: list[np.ndarray]) -> np.ndarray:
        """(texts, landmarks) kernel values of n-gram sets."""
        out = np.zeros((len(sets), self.members.shape[1]))
        for i, s in enumerate(sets):
            at = self.table[s]
            at = at[at >= 0]
            out[i] = self.members[at].sum(axis=0) / np.sqrt(max(len(at), 1))
        return out

    def trigram_share(self, grams: np.ndarray) -> float:
        threes = grams[grams < _TWO]
        return float((self.table[threes] >= 0).mean()) if len(threes) else 1.0


def fit(kernel_rows: np.ndarray, labels: np.ndarray, landmark_kernel: np.ndarray, ridge: float = RIDGE):
    """(languages, coefficients) of one-versus-rest kernel ridge regression."""
    languages = sorted(set(labels))
    y = np.where(labels[:, None] == np.array(languages, dtype=object)[None, :], 1.0, -1.0)
    # Every language weighs the same whatever its share of the sample.
    share = np.array([1 / np.sum(labels == lang) for lang in labels])[:, None] * len(labels) / len(languages)
    k = kernel_rows.astype(np.float64)
    normal = k.T @ (k * share) + ridge * landmark_kernel + 1e-6 * np.eye(k.shape[1])
    return languages, np.linalg.solve(normal, k.T @ (y * share))


def calibrate(kernel: Kernel, landmark_kernel: np.ndarray, whole: np.ndarray, labels: np.ndarray, folds: np.ndarray,
              pieces: list[np.ndarray], piece_labels: np.ndarray, piece_folds: np.ndarray) -> tuple[float, float]:
    """(least score, least share of known trigrams) that claim a text; see the module's text.

    ``whole`` has the kernel rows of the texts, of fold -1, 0 or 1; a piece is
    scored by the model of the texts that are not of its fold.  Without pieces
    nothing is rejected.
    """
    own, others, shares = [], [], []
    for fold in (0, 1):
        mine = np.flatnonzero(piece_folds == fold)
        rest = folds != fold
        languages, coefficients = fit(whole[rest], labels[rest], landmark_kernel) if rest.any() else ([], None)
        mine = mine[np.isin(piece_labels[mine], languages)]
        if not len(mine):
            continue
        sets = [pieces[i] for i in mine]
        scores = (kernel.of_sets(sets) @ coefficients + 1) / 2
        is_own = piece_labels[mine][:, None] == np.array(languages, dtype=object)[None, :]
        own.append(scores[is_own])
        others.append(scores[~is_own])
        shares += [kernel.trigram_share(s) for s in sets]
    if not own:
        return 0.0, 0.0
    return equal_errors(np.concatenate(own), np.concatenate(others)), float(LEAST_SHARE * np.quantile(shares, TAIL))


def equal_errors(own: np.ndarray, others: np.ndarray) -> float:
    """The score that as large a share of ``own`` stays under as of ``others`` reaches."""
    at = np.sort(np.concatenate([own, others]))
    under = np.searchsorted(np.sort(own), at, "left") / max(len(own), 1)
    reach = 1 - np.searchsorted(np.sort(others), at, "left") / max(len(others), 1)
    return float(at[np.argmin(np.abs(under - reach))]) if len(others) else float(own.min())


def _held_out():
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_MOD
    return F.coalesce(remainder == 0, F.lit(False))


def _lowered():
    """The text in lower case, null where it has no letter."""
    return F.when(F.col("text").rlike(r"\p{L}"), F.lower("text")).alias("text")


def train(docs: DataFrame) -> tuple | None:
    """(landmark n-gram sets, languages, coefficients, least score, least share) learned from ``docs(doc_id, text, lang)``."""
    spark = docs.sparkSession
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~_held_out()
                       & F.col("text").rlike(r"\p{L}"))
    # A hash threshold leaves about four times the sample of each language, so
    # that ranking a language with most of the rows stays a small task.
    # It counts ids, not rows, as the sample does.
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 31))
    rows = known.select("doc_id", "lang").distinct().withColumn("place", place)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    # One row per language, as many as the model has; a shuffle join would move all rows by language.
    ids = (rows.join(F.broadcast(sizes), "lang").where(F.col("place") * F.col("rows") <= float(4 * TRAIN_PER_LANG << 31))
           .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TRAIN_PER_LANG))
    ids = [(r["doc_id"], r["lang"], r["rank"]) for r in ids.collect()]
    if not ids:
        return None
    chosen = spark.createDataFrame(ids, "doc_id long, lang string, rank int")
    # Of rows that share doc_id and lang one is learned, however many there are.
    sample = (known.join(F.broadcast(chosen), ["doc_id", "lang"])
              .groupBy("lang", "rank").agg(F.min("text").alias("text")))

    def grams(batches):
        for batch in batches:
            data, offsets = string_buffers(batch.column(2))
            langs, ranks, sizes, sets = [], [], [], []
            for lang, rank, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), offsets[:-1], offsets[1:]):
                cuts = [(0, a, b)]
                if rank > LANDMARKS_PER_LANG:  # a fragment of each length, somewhere in the text
                    cuts += [(n, at, at + n) for n in FRAGMENTS if n < b - a
                             for at in [a + rank * 2654435761 % (b - a - n + 1)]]
                for size, start, end in cuts:
                    langs.append(lang)
                    ranks.append(rank)
                    sizes.append(size)
                    sets.append(gram_set(data[start:end]).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(ranks, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(sets, pa.binary())], names=["lang", "rank", "size", "grams"])

    rows = (sample.select("lang", "rank", _lowered())
            .mapInArrow(grams, "lang string, rank int, size int, grams binary").collect())
    rows.sort(key=lambda r: (r["lang"], r["rank"], r["size"], bytes(r["grams"])))
    sets = [np.frombuffer(r["grams"], dtype=np.int32) for r in rows]
    labels = np.array([r["lang"] for r in rows], dtype=object)
    whole = np.array([r["size"] == 0 for r in rows])
    # Landmarks are of no fold: every model knows them.
    folds = np.array([-1 if r["rank"] <= LANDMARKS_PER_LANG else r["rank"] % 2 for r in rows])
    landmarks = [s for r, s in zip(rows, sets) if r["size"] == 0 and r["rank"] <= LANDMARKS_PER_LANG]
    kernel = Kernel(landmarks)
    among, texts = kernel.of_sets(landmarks), kernel.of_sets([s for s, w in zip(sets, whole) if w])
    languages, coefficients = fit(texts, labels[whole], among)
    claims = calibrate(kernel, among, texts, labels[whole], folds[whole], [s for s, w in zip(sets, whole) if not w],
                       labels[~whole], folds[~whole])
    return landmarks, languages, coefficients, *claims


def scorer(spark, model: tuple | None) -> Callable:
    """A function for executors: string column (lower-cased, null: no letter) -> (languages, scores, claimed)."""
    if model is None:
        return lambda: lambda column: (["und"] * len(column), np.zeros(len(column)), np.zeros(len(column), dtype=bool))
    shared = spark.sparkContext.broadcast(model)

    def make():
        landmarks, languages, coefficients, least_score, least_share = shared.value
        kernel, names = Kernel(landmarks), np.array(languages, dtype=object)

        def score(column):
            data, offsets = string_buffers(column)
            best, margin, found, total, claims = [], [], [np.zeros(0)], [np.zeros(0)], [np.zeros(0, dtype=bool)]
            for a, b in blocks(data, offsets):
                rows, *trigrams = kernel.rows_and_trigrams(data, offsets[a:b + 1])
                margins = rows @ coefficients
                found.append(trigrams[0])
                total.append(trigrams[1])
                best.append(margins.argmax(axis=1))
                margin.append(margins.max(axis=1))
                judged = ((margin[-1] + 1) / 2 * total[-1] + 0.5 * PRIOR) / (total[-1] + PRIOR)
                claims.append(judged >= least_score)
            known = np.asarray(column.is_valid())
            best = np.concatenate([np.zeros(0, np.int64), *best])
            score = np.clip((np.concatenate([np.zeros(0), *margin]) + 1) / 2, 0, 1)
            found, total = np.concatenate(found), np.concatenate(total)
            claimed = known & np.concatenate(claims) & ((found + PRIOR) / (total + PRIOR) >= least_share)
            return np.where(known, names[best], "und"), np.where(known, score, 0.0), claimed

        return score

    return make


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs(doc_id, text, lang)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    make = scorer(docs.sparkSession, train(docs))

    def predict(batches):
        score = make()
        for batch in batches:
            languages, scores, _ = score(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(languages), pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", _held_out().alias("held_out"), _lowered()).mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")


def known_language(docs: DataFrame, least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` in a language that was learned, all columns as given.

    Rows that come out as ``und`` go, those that no learned language claims,
    and those below ``least_score``.
    """
    make, schema = scorer(docs.sparkSession, train(docs)), docs.schema
    width = len(docs.columns)

    def keep(batches):
        score = make()
        for batch in batches:
            _, scores, claimed = score(batch.column(width))
            good = pa.array(claimed & (scores >= least_score), pa.bool_())
            yield batch.select(list(range(width))).filter(good)

    return docs.select("*", _lowered().alias("__lowered")).mapInArrow(keep, schema)
