"""Operator 11: best-fit decreasing packing of tokenized documents into sequences.

A document is its token ids and an end id; one longer than a sequence is cut
into pieces of a sequence's length, the last piece may be shorter.  Pieces are
placed longest first, each into the open sequence with the least room that it
fits, found by a segment tree over the remaining capacities, or into a new one.

Pieces of one length are interchangeable, and so are sequences with equal room.
So the placement runs over the histogram of the piece lengths (at most
``CAPACITY`` rows, however many documents there are): each step takes the
tightest open run of sequences from the tree and fills it with as many equal
pieces as best fit would give it one by one.  The result is the same as that of
one document at a time.  A step is a rule "pieces number a to b of this length
go to the sequences from c on"; the rules are searched by each piece's number
among those of its length.  That number is the piece's place among its length
in the task that wrote it, plus what the tasks before it have of that length:
a window over one row per task and length.  No length is gathered in one task.

Edge cases: a null or empty text is the end id alone; a null doc_id is carried;
repeated rows are packed each for itself; extra columns are ignored; an empty
table gives no rows.  A text is split in parts, and only its ids are held whole.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.llm.common import materialize
from quarterlens.llm.wordtokens import worker_tokens

CAPACITY = 4096
END_ID = 1
#: Rows that are tokenized at once.
ROWS = 1024
#: Numbers of pieces of a length stay under this.
_MOST = 1 << 50

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class CapacityTree:
    """A segment tree over capacities 0..n: which are open, and the least open one from some capacity on."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.open = bytearray(2 * self.size)

    def set(self, capacity: int, is_open: bool) -> None:
        at = self.size + capacity
        self.open[at] = is_open
        while at > 1:
            at >>= 1
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The least open capacity that is not under ``least``."""
        at = self.size + least
        while not self.open[at]:
            while at & 1:  # a right child: what follows hangs off an ancestor
                at >>= 1
            if at == 0:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rules (length, first piece, first sequence, offset, pieces a sequence), by length and first piece."""
    tree = CapacityTree(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}  # by remaining capacity: (first sequence, sequences)
    rules, sequences = [], 0

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            if not runs.setdefault(room, []):
                tree.set(room, True)
            runs[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        done, total = 0, histogram[length]
        while done < total:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, count = sequences, -(-(total - done) // each)
                sequences += count
            else:
                each = room // length
                first, count = runs[room].pop()
                if not runs[room]:
                    tree.set(room, False)
            # Best fit goes on with a sequence while the next equal piece fits it.
            full = min(count, (total - done) // each)
            rules.append((length, done, first, capacity - room, each))
            put(room - each * length, first, full)
            done += full * each
            if full < count:
                rest = total - done
                put(room - rest * length, first + full, 1 if rest else 0)
                left = full + (1 if rest else 0)
                put(room, first + left, count - left)
                done = total
    return np.array(sorted(rules), dtype=np.int64).reshape(-1, 5)


def token_pieces(docs: DataFrame, spec: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs(doc_id, text)``; ``place`` counts the pieces of a length in the task ``part``."""

    def cut(batches):
        tokens, seen = worker_tokens(spec_of.value), Counter()
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], dtype=np.uint32)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                rows = []
                for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1).to_pylist())):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start:start + capacity]
                        rows.append((doc_id, n, start, len(piece), zlib.crc32(piece.tobytes()), part, seen[len(piece)]))
                        seen[len(piece)] += 1
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"])

    spec_of = docs.sparkSession.sparkContext.broadcast(spec)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(cut, _PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Each piece of ``docs(doc_id, text)`` with its sequence and its offset there.

    ``tokenizer`` is the path of a tokenizer file of the ``tokenizers`` library
    on the driver; by default the public word-level vocabulary.
    """
    spark = docs.sparkSession
    with open(tokenizer or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    pieces = materialize(token_pieces(docs, spec, capacity), "pack-pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # One row a length, at most ``capacity`` of them.
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rules = spark.sparkContext.broadcast(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("number"))

    def place(batches):
        lengths, begins, firsts, offsets, each = rules.value.T
        keys = lengths * _MOST + begins
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            number = batch.column(5).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * _MOST + number, "right") - 1
            n = number - begins[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(firsts[at] + n // each[at]),
                 pa.array(offsets[at] + n % each[at] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(place, _PLACED)
