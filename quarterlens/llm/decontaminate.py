"""Operator 2: benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised: lower case, every run of characters other
than letters and digits becomes one space.  An item of n characters may differ
from a passage of a document by ``ERROR_RATE`` * n edits, k.  Cut into k + 1
pieces, at least one piece must then occur in the passage unchanged.  All
pieces are searched at once (Aho-Corasick), and each hit's surroundings are
verified by Myers' bit-parallel edit distance, so nothing within the budget is
missed.  An item too short for one error has to occur whole, between word
boundaries.

The benchmark is read in blocks of at most about ``BLOCK_CHARS`` characters;
each block is broadcast for one pass over the documents, so a broadcast never
grows with the benchmark.  Documents are never shuffled.

Edge cases: null texts and items, and items without a letter or digit, match
nothing; a repeated row gives repeated results; a null doc_id or item_id is
carried as it is; extra columns of the documents are ignored by ``leaks`` and
kept by ``drop_leaks``; an empty benchmark or table matches nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.08
BLOCK_CHARS = 2_000_000

_GAP = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _GAP.sub(" ", (text or "").lower()).strip()


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 consecutive pieces of nearly equal length, with offsets."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def char_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_distance(masks: dict[str, int], m: int, text: str) -> int:
    """Least edit distance of the pattern (its masks and length) to a substring of ``text``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best = m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | vn
        xh = (((eq & vp) + vp) ^ vp) | eq
        hp = vn | (~(xh | vp) & full)
        hn = vp & xh
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
            if score < best:
                best = score
        hp = (hp << 1) & full  # row 0 stays 0: a match may begin anywhere
        hn = (hn << 1) & full
        vp = hn | (~(xv | hp) & full)
        vn = hp & xv
    return best


class Matcher:
    """Finds the items of one benchmark block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self.items, where = [], {}
        for item_id, text in items:
            norm = normalise(text)
            if not norm:
                continue
            errors = int(len(norm) * rate)
            if not errors:
                norm = f" {norm} "
            for offset, piece in pieces(norm, errors):
                where.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, len(norm), errors, char_masks(norm)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> Iterator[tuple[int, int]]:
        """(item_id, least distance) of each item within its budget in ``text``."""
        if not text or not self.items:
            return
        text = f" {normalise(text)} "
        starts: dict[int, set[int]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for item, offset in places:
                starts.setdefault(item, set()).add(end + 1 - length - offset)
        for item, found in starts.items():
            item_id, n, errors, masks = self.items[item]
            best, done = errors + 1, None
            for start in sorted(found):
                if done is not None and start <= done:
                    continue
                # One window serves all starts up to ``errors`` further on.
                window = text[max(0, start - errors):start + n + 2 * errors]
                done = start + errors
                best = min(best, best_distance(masks, n, window))
                if not best:
                    break
            if best <= errors:
                yield item_id, best


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in bounded blocks on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for i in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r.item_id, r.text) for r in block.collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, item_id, distance) for each item that a document contains."""
    spark, out = docs.sparkSession, None
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, distance int"
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                rows = [(d, i, k) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                        for i, k in matcher.find(t)]
                ids, items, distances = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(items, pa.int64()), pa.array(distances, pa.int32())],
                    names=["doc_id", "item_id", "distance"])

        found = docs.mapInArrow(scan, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as given."""
    at = docs.columns.index("text")
    for block in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                keep = [next(matcher.find(t), None) is None for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
