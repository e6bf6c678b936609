from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from quarterlens.llm import chat, decontaminate, language, quality, secrets
from quarterlens.llm.textkernel import word_hashes

from .conftest import SF


def edit_substring(pattern, text):
    """Least edit distance of ``pattern`` to a substring, by the full table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i + 1] + 1, new[i] + 1, row[i] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=120))
def test_bit_parallel_distance(pattern, text):
    assert decontaminate.best_distance(decontaminate.char_masks(pattern), len(pattern), text) == edit_substring(pattern, text)


@settings(max_examples=60, deadline=None)
@given(st.text("ab cd", min_size=30, max_size=80), st.text("ab cd", max_size=40), st.lists(st.integers(0, 10_000), max_size=4))
def test_pigeonhole_misses_nothing(item, around, edits):
    norm = decontaminate.normalise(item)
    damaged = list(norm)
    for e in edits:
        if damaged:
            damaged[e % len(damaged)] = "x"
    text = around + " " + "".join(damaged) + " " + around
    budget = int(len(norm) * decontaminate.ERROR_RATE)
    found = dict(decontaminate.Matcher([(1, item)]).find(text))
    full = f" {decontaminate.normalise(text)} "
    want = edit_substring(norm if budget else f" {norm} ", full) if norm else 99
    assert found == ({1: want} if want <= budget else {})


def test_leaks_of_the_tables(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(documents, benchmark).collect()}
    texts = {r.doc_id: decontaminate.normalise(r.text) for r in documents.collect()}
    items = {r.item_id: decontaminate.normalise(r.text) for r in benchmark.collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert exact and exact == {k for k, v in got.items() if v == 0}
    assert all(edit_substring(items[i], texts[d]) == v for (d, i), v in list(got.items())[:20])
    kept = {r.doc_id for r in decontaminate.drop_leaks(documents, benchmark).select("doc_id").collect()}
    assert kept == set(texts) - {d for d, _ in got}


def test_leaks_blocks_and_odd_rows(spark, odd_documents, monkeypatch):
    items = spark.createDataFrame([(1, "quick brown fox jumps"), (2, None), (3, "!!"), (4, "word5x5 word6x6 word7x7"),
                                   (None, "lazy dog")], "item_id long, text string")
    whole = sorted(decontaminate.leaks(odd_documents, items).collect(), key=str)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 10)
    assert whole == sorted(decontaminate.leaks(odd_documents, items).collect(), key=str)
    assert {(r.doc_id, r.item_id) for r in whole} == {(d, i) for d in (1, 2, None) for i in (1, None)} | {(8, 4), (9, 4)}
    assert decontaminate.leaks(odd_documents, items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(odd_documents, items.limit(0)).count() == odd_documents.count()
    assert decontaminate.drop_leaks(odd_documents, items).columns == odd_documents.columns


def plain_base(text):
    out = []
    for kind, pattern, flags, ok in (
            ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
             re.I | re.A, lambda m: len(m[2]) >= 8),
            ("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 16),
            ("hex", r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 32)):
        out += [(kind, *m.span()) for m in re.finditer(pattern, text, flags) if ok(m)]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_spans_of_the_tables(documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = secrets.scan_secrets(documents).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        n = Counter(k for k, _, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (n["assign"], n["access"], n["hex"])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "SECRET", "api_key", "=", ":", " ", '"', "AKIA", "ABCDEFGH1234", "deadbeef" * 4,
                                 "x", "é", "ſecret", "abcdefgh", "\n"]), max_size=14).map("".join))
def test_base_spans_of_any_text(text):
    assert secrets.base_spans(text) == plain_base(text)


def lexed(text):
    return [text[a:b] for k, a, b in secrets.all_spans(text)[1] if k == "lexed"]


def test_lexing_propagates_constants():
    assert lexed('K = "q8Zr1xT0vLp3"\nclient.db_credentials = K\n') == ["q8Zr1xT0vLp3"]
    assert lexed('a = "q8Zr1xT0vLp3"\nb = a\nauth_header = b\n') == ["q8Zr1xT0vLp3"]
    assert lexed('title = "q8Zr1xT0vLp3"\nname = title\n') == []
    assert lexed("privateKey: 'Hy7/kk2+Pq91=='") == ["Hy7/kk2+Pq91=="]
    assert lexed('pwd = "please change this"') == []
    assert secrets.redact('x; K = "q8Zr1xT0vLp3"\ndb_credentials = K') == 'x; K = "[REDACTED]"\ndb_credentials = K'


def test_long_names_literals_and_chains():
    value = "".join(chr(97 + (i * 7 + i // 26) % 26) + str(i % 10) for i in range(4000))
    assert lexed(f"pwd = '{value}'") == [value]
    assert lexed(f'{"long_" * 30}credentials = "q8Zr1xT0vLp3"') == ["q8Zr1xT0vLp3"]
    chain = 'v0 = "q8Zr1xT0vLp3"\n' + "".join(f"v{i + 1} = v{i}\n" for i in range(20_000)) + "auth = v20000\n"
    assert lexed(chain) == ["q8Zr1xT0vLp3"]
    assert secrets.propagated({"a", "b"}, {"a": {"b"}, "b": {"a", "pwd"}}) == {"a": 0.9, "b": 0.9, "pwd": 0.9}


def test_pairs_aligned_in_columns():
    for n in (1, 4, 5, 17, 40):
        for gap in (" " * n, "\t" * n, " \t" * n):
            assert lexed(f'db_pwd{gap}={gap}"hV7kq2PzX9wT4"') == ["hV7kq2PzX9wT4"]
            assert lexed(f"client_credential:{gap}'hV7kq2PzX9wT4'\n") == ["hV7kq2PzX9wT4"]
            assert lexed(f'k{gap}= "hV7kq2PzX9wT4"\npassword{gap}={gap}k\n') == ["hV7kq2PzX9wT4"]
    assert lexed(f'{"word " * 3}{" " * 200_000}x{" " * 200_000}') == []


def test_redaction_and_odd_rows(spark, odd_documents):
    assert secrets.scan_secrets(odd_documents).count() == odd_documents.count()
    out = secrets.redact_secrets(odd_documents)
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    docs = spark.createDataFrame([(1, 'a token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" b', 5)], "doc_id long, text string, n_chars long")
    row = secrets.redact_secrets(docs).first()
    assert (row.text, row.n_chars) == ('a [REDACTED]" b', 15)
    assert secrets.scan_secrets(odd_documents.limit(0)).count() == 0


def held_out(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


def test_language_on_held_out_documents(documents):
    rows = {r.doc_id: r for r in language.identify(documents).collect()}
    texts = {r.doc_id: r for r in documents.collect()}
    assert set(rows) == set(texts)
    assert all(r.held_out == (held_out(d, 5) == 0) for d, r in rows.items())
    judged = [d for d, r in rows.items() if r.held_out and r.lang_pred != "und"]
    assert sum(rows[d].lang_pred == texts[d].lang for d in judged) >= 0.97 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_odd_rows(spark, odd_documents):
    rows = {r.doc_id: r for r in language.identify(odd_documents).collect()}
    assert all(rows[d].lang_pred == "und" and rows[d].score == 0 for d in (3, 4, 5, 10))
    assert rows[8].lang_pred in ("en", "de") and rows[8].score == rows[9].score
    assert language.identify(odd_documents.limit(0)).count() == 0
    kept = language.known_language(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 2, 6, 7, 8, 9]
    unlearned = odd_documents.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language.identify(unlearned).collect()} == {"und"}


def test_kernel_equals_plain_sets():
    import numpy as np
    import pyarrow as pa
    from quarterlens.llm.textkernel import string_buffers

    texts = ["the cat sat", "", "über die brücke", "a" * 1000 + " das " * 300_000, "x1y2"]

    def plain(t):
        b = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in t.encode())
        return {b[i:i + n] for n in (1, 2, 3) for i in range(len(b) - n + 1)}

    code = lambda g: (len(g) == 1 and g[0] + language._ONE or len(g) == 2 and (g[0] << 8 | g[1]) + language._TWO
                      or g[0] << 16 | g[1] << 8 | g[2])
    data, offsets = string_buffers(pa.array(texts))
    sets = [language.gram_set(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    assert [set(s.tolist()) for s in sets] == [{code(g) for g in plain(t)} for t in texts]
    kernel = language.Kernel([sets[0], sets[2]])
    got = np.concatenate([kernel.rows(data, offsets[a:b + 1]) for a, b in language.blocks(data, offsets)])
    marks = [plain(texts[0]), plain(texts[2])]
    for i, t in enumerate(texts):
        known = plain(t) & (marks[0] | marks[1])
        want = [len(known & m) / max(len(known), 1) ** 0.5 / len(m) ** 0.5 for m in marks]
        assert np.allclose(got[i], want, atol=1e-5)


def test_quality_on_held_out_documents(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in quality.score_quality(documents, labels).collect()}
    assert len(rows) == documents.count()
    assert all(r.held_out == (held_out(d, 4) == 2) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    judged = [(rows[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in rows and rows[r.doc_id].held_out]
    assert sum(p.predicted == q for p, q in judged) >= 0.9 * len(judged)


def test_quality_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (8, None)], "doc_id long, quality int")
    rows = quality.score_quality(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.score_quality(odd_documents, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(odd_documents.limit(0), labels).count() == 0


def test_word_hashes_follow_words():
    import pyarrow as pa

    texts = ["", None, "a b", " A\tb ", "b a a", "ab", "x " * 700_000 + "tail", "é É"]
    by_word = {}
    for text, hashes in zip(texts, word_hashes(pa.array(texts))):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist()):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


ROLE = st.text(st.sampled_from("ab:\\\n #"), max_size=6)
BODY = st.lists(st.sampled_from(["### ", "</turn>", "\\", "\n", "### user: ", "x", "</turn>\n", "é", "</tur", "#"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLE, BODY), max_size=4))
def test_chat_round_trip(turns):
    pieces = [chat.format_turn(r, t) for r, t in turns]
    back = chat.parse("".join(p for p, _, _ in pieces))
    assert [t[:2] for t in back] == turns


def test_chat_digests(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 0, "system", "s"), (-7, 0, "user", r"\### Assistant: </turn> ok"),
            (-7, 1, "assistant", r"\### Assistant: </turn> ok"), (None, 0, None, "n"), (2, None, "assistant", "x"), (2, 1, "assistant", "é")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    pieces = chat.format_turns(turns).cache()
    got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    whole = {r.conv_id: r.formatted for r in chat.formatted_conversations(pieces).collect()}
    assert set(got) == {1, -7, None, 2}
    want = {1: ("system\ns\nuser\n\nassistant\nb\n", "b", 3), 2: ("assistant\nx\nassistant\né\n", "xé", 2), None: ("\nn\n", "", 1)}
    tricky = r"\### Assistant: </turn> ok"
    want[-7] = (f"user\n{tricky}\nassistant\n{tricky}\n", tricky, 2)
    for conv, (turns_text, loss, n) in want.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (n, sha(turns_text), len(loss), sha(loss))
        assert r.formatted_chars == len(whole[conv])
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def test_repeated_rows_do_not_shrink_the_language_sample(spark):
    """One doc_id with most rows of its language: the others are learned all the same."""
    rows = [(i, f"alpha{i} beta gamma delta", "xx") for i in range(1, 201)]
    rows += [(i, f"omega{i} psi chi phi", "yy") for i in range(1001, 1201)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hot = spark.range(200_000).selectExpr("5000L as doc_id", "'alpha beta gamma' as text", "'xx' as lang")
    def learned(docs):
        landmarks, languages, *_ = language.train(docs)
        return len(landmarks), languages
    assert learned(docs.unionByName(hot)) == learned(docs) == (2 * language.LANDMARKS_PER_LANG, ["xx", "yy"])


def test_a_hot_labelled_document_is_learned_once(spark, monkeypatch):
    rows = [(i, f"text number {i} with some words", i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    hot = spark.range(5000).selectExpr("3L as doc_id", "concat('other text ', id) as text")
    seen = []
    monkeypatch.setattr(quality, "fit_rules", lambda x, y: seen.append((len(x), sorted(y))) or (0.5, None))
    quality.train(docs, labels)
    quality.train(docs.unionByName(hot), labels.unionByName(labels))
    assert seen[0] == seen[1] and seen[0][0] <= 60
