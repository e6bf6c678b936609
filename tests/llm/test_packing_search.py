from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarterlens.llm import lexical, negatives, packing, wordtokens

from .conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")


# --- operator 11 ------------------------------------------------------------

def best_fit(lengths, capacity):
    """Rooms left, one document at a time."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def placed(rules, histogram):
    """sequence -> [(offset, length)] by the rules, checked to be without gaps."""
    used = {}
    for length, count in histogram.items():
        mine = rules[rules[:, 0] == length]
        for number in range(count):
            _, begin, first, offset, each = mine[np.searchsorted(mine[:, 1], number, "right") - 1]
            n = number - begin
            used.setdefault(int(first + n // each), []).append((int(offset + n % each * length), length))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    return used


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(1)
    for _ in range(500):
        capacity = rnd.choice([7, 10, 16, 33, 100])
        histogram = {rnd.randint(1, capacity): rnd.randint(1, 12) for _ in range(rnd.randint(0, 12))}
        used = placed(packing.plan(histogram, capacity), histogram)
        rooms = sorted(capacity - sum(n for _, n in v) for v in used.values())
        assert rooms == best_fit([k for k, n in histogram.items() for _ in range(n)], capacity)
    assert len(packing.plan({n: 10 ** 9 + n for n in range(1, 4097)})) < 20_000


def test_capacity_tree():
    rnd, tree, on = random.Random(2), packing.CapacityTree(100), set()
    for _ in range(3000):
        capacity, is_open, least = rnd.randint(0, 100), rnd.random() < 0.3, rnd.randint(0, 100)
        tree.set(capacity, is_open)
        (on.add if is_open else on.discard)(capacity)
        assert tree.tightest(least) == min((x for x in on if x >= least), default=None)


def test_tokens_equal_the_library(monkeypatch):
    library = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        tokens = wordtokens.Tokens(f.read())
    rnd = random.Random(3)
    alphabet = "abst'TrRevElLmMdD 0123\n\t.,'\"!é ÉñÑßŸÿŒœ×÷İſǅ中ｅé́´’ ​Σ<|startoftext|><|endoftext|>"
    texts = ["".join(rnd.choice(alphabet[:rnd.choice([30, 45, len(alphabet)])]) for _ in range(rnd.randint(0, 40)))
             for _ in range(3000)]
    texts += ["<|endoftext|> a <|startoftext|>b", "it's we're they'll''s 'sick .'s x'", "", " \n", None, "'", "x'l"]
    for block, memory in ((1 << 20, 10 ** 6), (50, 40)):
        monkeypatch.setattr(wordtokens, "BLOCK", block)
        monkeypatch.setattr(wordtokens, "MEMORY", memory)
        tokens.forget()
        for text, ids in zip(texts, tokens.encode(texts)):
            assert library.encode(text or "", add_special_tokens=False).ids == ids.tolist(), text
    assert tokens.plain
    other = wordtokens.Tokens(library.to_str().replace("'s|'t|", ""))  # another split: the library alone
    assert not other.plain and other.encode(["it's"])[0].tolist() == other.tokenizer.encode("it's").ids


def check_packing(rows, texts, capacity):
    """``texts`` is the multiset of (doc_id, text)."""
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            piece = ids[at:at + capacity]
            want[doc_id, n, at, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = sorted(capacity - sum(n for _, n in v) for v in sequences.values())
    assert rooms == best_fit([r.length for r in rows], capacity)


def test_packing_of_the_table(spark, documents):
    rows = packing.pack(documents.repartition(7)).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], 4096)


@pytest.mark.parametrize("capacity", [5, 64])
def test_packing_of_odd_rows(spark, odd_documents, capacity):
    docs = odd_documents.where("doc_id is null or doc_id not in (8, 9)")
    packed = packing.pack(docs.withColumnRenamed("component_id", "sequence_id"), PATH, capacity)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_packing(packed.collect(), [(r.doc_id, r.text) for r in docs.collect()], capacity)
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_of_a_very_long_text(spark, odd_documents):
    docs = odd_documents.where("doc_id in (8, 9)")
    rows = packing.pack(docs).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096)


# --- operator 12 ------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def all_terms(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(folded)


def brute_search(docs, items, k=20):
    docs = [(i, Counter(t), len(t)) for i, t in ((i, all_terms(t)) for i, t in docs) if t]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in sorted(set(items), key=str):
        query, scored = Counter(all_terms(text)), []
        for doc_id, counts, n in docs:
            m = 100 - 25 + 25 * n * n_docs // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m)) for t, q in query.items() if t in counts)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_terms_are_cut_like_the_whole_text(monkeypatch):
    text = "Ab cÉ d'e_F9 \x00x\x7fy中文 " * 30 + "long" * 400 + " z"
    want = [t.encode() for t in all_terms(text)]
    for part in (1, 2, 7, 64, 1 << 20):
        monkeypatch.setattr(lexical, "PART", part)
        assert [w for words in lexical.terms(text.encode()) for w in words] == want


def test_search_of_the_table(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = brute_search(docs, [(r.item_id, r.text) for r in items.collect()])
    assert found(lexical.search(documents.repartition(5), items)) == want


def test_search_of_odd_rows_and_blocks(spark, odd_documents, monkeypatch):
    items = [(1, "The lazy lazy dog"), (1, "The lazy lazy dog"), (1, "one"), (2, None), (3, ""), (None, "fox TWO"),
             (4, "absent"), (5, "!!"), (6, "word5x5 word5x5 12345 the")]
    frame = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, rank int")
    want = brute_search([(r.doc_id, r.text) for r in odd_documents.collect()], [x for x in items if x[1]])
    assert found(lexical.search(odd_documents.withColumnRenamed("component_id", "score"), frame)) == want
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 12)
    assert found(lexical.search(odd_documents, frame)) == want
    assert lexical.search(odd_documents.limit(0), frame).count() == 0
    assert lexical.search(odd_documents, frame.limit(0)).count() == 0


def test_best_positions_stop_early_and_strictly():
    """Equal scores at the threshold are still read; a clear winner ends the search."""
    rnd = np.random.default_rng(4)
    for trial in range(200):
        n, m, k = int(rnd.integers(1, 60)), int(rnd.integers(1, 5)), int(rnd.integers(1, 6))
        full = rnd.integers(0, 4, size=(m, n))  # many ties
        term, doc = np.nonzero(full)
        shard = lexical.Shard(term.astype(np.int64), doc, full[term, doc].astype(np.int64), n)
        weights, ids = rnd.integers(0, 4, size=m), rnd.permutation(n)
        floor = int(rnd.integers(0, 3))
        docs, scores, _ = shard.search(np.arange(m), weights, ids, floor, k, step=1)
        total = weights @ full
        want = [(-total[d], ids[d]) for d in range(n) if total[d] > 0 and total[d] >= floor]
        assert [(-s, ids[d]) for d, s in zip(docs, scores)] == sorted(want)[:k]
    n = 10_000  # one document leads both lists
    impact = np.concatenate([[10 ** 6], np.ones(n - 1, dtype=np.int64)])
    term = np.repeat([0, 1], n)
    shard = lexical.Shard(term, np.tile(np.arange(n), 2), np.tile(impact, 2), n)
    docs, _, accesses = shard.search(np.array([0, 1]), np.array([1, 1]), np.arange(n), 0, 1)
    assert docs.tolist() == [0] and accesses <= 4 * lexical.FIRST_STEP


# --- operator 13 ------------------------------------------------------------

def brute_negatives(rows):
    known = set()
    for vec_id, x, label in rows:
        if vec_id is None or label is None or not x or any(c is None or not math.isfinite(c) for c in x):
            continue
        known.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(math.floor(256 * c) for c in x)))
    out = set()
    for a, label, v in known:
        if a % 50:
            continue
        scored = {(-sum(p * q for p, q in zip(v, w)), b, other == label) for b, other, w in known if b != a and len(w) == len(v)}
        for ps, positive in sorted((s, b) for s, b, same in scored if same)[:5]:
            good = sorted((s, b) for s, b, same in scored if not same and -50 * ps <= -100 * s <= -95 * ps)[:3]
            out |= {(a, positive, r, b, -ps, -s) for r, (s, b) in enumerate(good, 1)}
    return sorted(out)


def mined(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_negatives_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    got = mined(negatives.hard_negatives(table.repartition(6)))
    assert got and got == brute_negatives(rows)


@pytest.mark.parametrize("cells", [64, 1 << 17])
def test_negatives_of_hot_vectors_and_many_lengths(spark, monkeypatch, cells):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 5)  # several passes
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 8)) * np.exp(rng.normal(size=(700, 1)))
    x[100:400] = x[100]  # a common vector
    x[500:520] = 0
    x[600] *= 1e4
    rows = [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = mined(negatives.hard_negatives(table))
    assert got and got == brute_negatives(rows)


def test_negatives_of_odd_rows(spark):
    ok = [1.0, 0.5]
    rows = [(0, ok, 1), (0, ok, 1), (50, ok, 1), (100, ok, None), (150, None, 1), (None, ok, 1), (200, [], 1),
            (1, [float("nan"), 1.0], 1), (2, [1.0, None], 2), (3, [float("inf"), 1.0], 2), (4, [0.8, 0.4], 2),
            (5, [0.8, 0.4], 2), (5, [0.8, 0.4], 2), (6, [1.0], 2), (8, [0.9, 0.5], 1), (9, [-1.0, -1.0], 1),
            (10, [0.0, 0.0], 1), (11, [0.0, 0.0], 2), (250, [0.0, 0.0], 1), (12, [1e20, 1.0], 2)]
    table = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, label int, rank int")
    want = brute_negatives([r for r in rows if r[0] != 12])  # its products do not fit 64 bits
    assert want and mined(negatives.hard_negatives(table)) == want
    assert negatives.hard_negatives(table.limit(0)).count() == 0
    assert negatives.hard_negatives(table.where("vec_id = 1")).count() == 0


def test_feasible_ranges_lose_nothing():
    rng = np.random.default_rng(6)
    pa_rows = [(i, 0, (rng.normal(size=6) * 300 * rng.exponential()).astype(np.int64)) for i in range(500)]
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in pa_rows]), pa.array([r[1] for r in pa_rows]), pa.array([r[2].tolist() for r in pa_rows], pa.list_(pa.int64()))],
        names=["vec_id", "label", "v"])
    seen = tried = 0
    for bucket in negatives.Bucket.read(negatives._pack([batch])):
        for _, _, v in pa_rows[:60]:
            length = float(np.sqrt((v.astype(float) ** 2).sum()))
            products = bucket.vectors @ v
            for least in (1, int(length * bucket.longest * 0.9), int(products.max())):
                got = bucket.candidates(v / max(length, 1e-300), length, least)
                assert set(np.flatnonzero(products >= max(least, 1))) <= set(got)
                seen, tried = seen + len(got), tried + len(products)
    assert seen < 0.7 * tried
