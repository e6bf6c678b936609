from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterlens.llm import mixing, near_dedup
from quarterlens.llm.components import connected_components
from quarterlens.llm.textkernel import shingle_set, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(sets):
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    both = Counter()
    for ids in where.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                both[a, b] += 1
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), c in both.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {d: top(d) for d in sets}


def test_components_match_brute_force(documents):
    sets = {r.doc_id: shingles(r.text) for r in documents.select("doc_id", "text").collect()}
    want = brute_components(sets)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(documents).collect()}
    assert {d: r.component_id for d, r in got.items()} == want
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(s) for d, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_dense_region_and_its_outliers(spark):
    """A large group of near copies in which every copy differs, and near misses beside it."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(600):
        words = list(base)
        words[i % 60] = f"v{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:30] + [f"u{i}_{j}" for j in range(30)])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components({d: shingles(t) for d, t in rows})
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()} == want


def test_links_between_near_misses(spark):
    """Texts of similarity 0.695 to each other, some with one partner at 0.754: the further orders find it."""
    rnd = random.Random(3)
    fresh = lambda k: [f"w{rnd.randrange(10 ** 7)}" for _ in range(k)]
    shared, rows, want = fresh(150), [], {}
    for i in range(400):
        words = shared + fresh(32)
        rows.append((2 * i, " ".join(words)))
        want[2 * i] = 2 * i
        if i % 5 == 0:
            rows.append((2 * i + 1, " ".join(words[:-25] + fresh(25))))
            want[2 * i + 1] = 2 * i
    a, b, c = (shingles(rows[i][1]) for i in (0, 1, 2))
    assert len(a & b) / len(a | b) >= 0.75 > 0.7 > len(a & c) / len(a | c)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == want


def test_links_of_crowded_runs_that_no_deeper_run_shows(spark, monkeypatch):
    """Partners at 0.751 that share only crowded runs of the least depth, without the guesses of steps 1 and 2."""
    for step in ("_heads", "_outsiders"):
        monkeypatch.setattr(near_dedup, step, lambda runs, real=getattr(near_dedup, step): real(runs).limit(0))
    rnd = random.Random(5)
    fresh = lambda k: [f"w{rnd.randrange(10 ** 7)}" for _ in range(k)]
    keys = lambda t: near_dedup.prefix_keys(near_dedup.signature(shingle_set(next(word_hashes(pa.array([t]))))))
    shared = fresh(135)
    texts = [" ".join(shared + fresh(45)) for _ in range(300)]
    want, singles = list(range(300)), np.array([keys(t)[0] for t in texts])
    while len(texts) < 316:
        words = shared + fresh(45)
        two = [" ".join(words), " ".join(words[:-25] + fresh(25))]
        a, b = map(keys, two)
        crowd = (singles == a[0]).sum(axis=0)[a[0] == b[0]]
        if len(crowd) and crowd.min() > near_dedup.MINORS and not (a[1] == b[1]).any():
            want += [len(texts)] * 2
            texts += two
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()} == dict(enumerate(want))


def test_odd_rows(spark, odd_documents):
    got = near_dedup.near_duplicates(odd_documents)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in got.where("doc_id is not null").collect())
    assert [r[:3] for r in rows if r[0] in (1, 2)] == [(1, 5, 1), (2, 5, 1), (2, 5, 1)]
    by_id = {r[0]: r for r in rows}
    assert by_id[3] == (3, 0, 3, True) and by_id[4] == (4, 0, 4, True) and by_id[5] == (5, 0, 5, True)
    assert by_id[7] == (7, 1, 6, False) and by_id[9][2:] == (8, False)
    assert [tuple(r)[2:] for r in got.where("doc_id is null").collect()] == [(None, True)] * 2
    kept = near_dedup.drop_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 8, 10]
    assert near_dedup.near_duplicates(odd_documents.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 33])
def test_connected_components_of_paths(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(100 + n, 100), (7000, 7000), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {**{i: 0 for i in range(n + 1)}, 100: 100, 100 + n: 100}


def words(text):
    return len(WORD.findall(text or ""))


def test_mix_meets_targets(documents):
    rows = mixing.mix_sources(documents).collect()
    text = {r.doc_id: r for r in documents.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    sizes = Counter()
    for r in text.values():
        sizes[r.source] += words(r.text)
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, free, target = sum(sizes.values()), list(order), {}
    while any(left * weights[s] / sum(weights[x] for x in free) > 3 * sizes[s] for s in free):
        s = next(s for s in free if left * weights[s] / sum(weights[x] for x in free) > 3 * sizes[s])
        target[s] = 3 * sizes[s]
        left -= target[s]
        free.remove(s)
    target.update({s: left * weights[s] / sum(weights[x] for x in free) for s in free})
    taken = Counter()
    for r in rows:
        assert r.size == words(text[r.doc_id].text) and 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[text[r.doc_id].source]
        assert abs(r.target - target[text[r.doc_id].source]) < 1e-6
        taken[text[r.doc_id].source] += r.taken
    assert all(abs(taken[s] - target[s]) <= max(0.01 * target[s], 30) for s in order)
    assert sorted(rows) == sorted(mixing.mix_sources(documents).collect())


def test_mix_cut_inside_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 10)
    docs = spark.range(1000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 7 as int)) as text",
                                        "if(id % 3 = 0, 'b', 'a') as source")
    rows = mixing.mix_sources(docs).collect()
    for s in "ab":
        mine = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 7


def test_mix_walks_equal_rows_of_a_hot_key_together(spark):
    docs = spark.range(9000).selectExpr("if(id % 3 = 0, id, null) as doc_id", "'one two' as text",
                                        "if(id % 4 = 0, 'b', 'a') as source")
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == 9000 and {r.size for r in rows} == {2}
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    for s in "ab":
        mine = [r for r in rows if r.source == s]
        assert all(r.taken in (0, 2, 4, 6) for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2


def test_flow_prefers_fresh_words_and_uses_overlap():
    flow = mixing.min_cost_flow({("a",): 10, ("a", "b"): 10, ("b",): 2}, {"a": 12, "b": 11})
    to = Counter()
    for (_, s), w in flow.items():
        to[s] += w
    assert to == {"a": 12, "b": 11}
    # 22 fresh words are there, so just one is repeated.
    given_ = Counter()
    for (p, _), w in flow.items():
        given_[p] += w
    assert sum(max(0, w - n) for w, n in zip((given_[("a",)], given_[("a", "b")], given_[("b",)]), (10, 10, 2))) == 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 50), min_size=1),
       st.lists(st.integers(1, 5), min_size=6, max_size=6))
def test_targets_share_everything(sizes, weights):
    target = mixing.targets_by_weight(sizes, dict(zip("abcdef", weights)))
    assert sum(target.values()) == sum(sizes.values())
    assert all(0 <= target[s] <= 3 * sizes[s] for s in sizes)


def test_mix_odd_rows(spark, odd_documents):
    rows = mixing.mix_sources(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {r.source for r in rows} == {None, "a", "b", "c"}
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix_sources(odd_documents.limit(0)).count() == 0


def test_sorted_orders_give_longest_common_prefixes():
    """Neighbours and runs of sorted rows, streamed in batches of any size, against a plain comparison of labels."""
    rng = np.random.default_rng(5)
    sigs = rng.integers(0, 2, size=(300, near_dedup.TREES, near_dedup.DEPTHS[-1]), dtype=np.uint32)
    sigs[200:, :, 4:] = 1
    rows = [(int(k), int(a), int(b), i, t) for i, s in enumerate(sigs)
            for t, (k, a, b) in enumerate(near_dedup.order_rows(s).T.view(np.int64))]
    rows.sort()
    shared = lambda x, y: x[4] == y[4] and next(
        (d for d in range(12) if sigs[x[3], x[4], d] != sigs[y[3], y[4], d]), 12) or 0
    depth = [d if d >= 4 else 0 for d in map(shared, rows[1:], rows)]
    keys = {i: near_dedup.prefix_keys(s).view(np.int64) for i, s in enumerate(sigs)}
    want = []
    for i, (*_, node, tree) in enumerate(rows):
        before, after = (depth[i - 1] if i else 0), (depth[i] if i + 1 < len(rows) else 12)
        deepest = 12 if i == 0 else max(before, after)
        if deepest >= 4:
            want.append((node, 9, *(int(k) if deepest >= d else None for k, d in zip(keys[node][:, tree], near_dedup.DEPTHS)),
                         rows[i - 1][3] if before else None, 9 if before else None, before))
    for size in (1, 7, 5000, len(rows)):
        batches = [pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*((r[3], 9, *r[:3]) for r in rows[at:at + size]))],
            names=["node", "n", "key", "r1", "r2"]) for at in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in near_dedup._neighbours(batches) for r in b.to_pylist()]
        assert got == want
    assert list(near_dedup._neighbours([])) == []
