from __future__ import annotations

import gzip
import hashlib
import html
import io
import re

import duckdb
import numpy as np
import pytest

from quarterlens.llm import html_text, oracle, registry, vectors, warc

from .conftest import SF


def test_archives_match_sql(spark):
    got = sorted(map(tuple, registry.op6_warc(spark, SF).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to, intact FROM ({oracle.WARC})").fetchall()
    assert got == sorted(want)


def test_archive_odd_rows(spark, tmp_path):
    big = "<p>" + "é" * 1_500_000
    same = "s" * 1200
    rows = [(1, "http://a/\r\n b", big, 1), (2, None, None, 2), (3, "http://c", same, 3), (9, "http://d", same, 4),
            (9, "http://d", same, 4), (None, "http://e", same, 5), (4, "u", "short", 6), (5, "u", "short", 7),
            (6, "u", "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n", 8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    manifest = warc.write_archives(warc.plan_records(pages), str(tmp_path / "out")).cache()
    got = warc.record_table(warc.read_chunks(manifest)).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    for r in got:
        assert (r.record_type == "revisit") == (r.page_id in (3, None)) and r.refers_to == (9 if r.page_id in (3, None) else None)
    payload = {i: (h or "").encode() for i, _, h, _ in rows}
    assert all((r.payload_bytes, r.payload_digest) == (len(payload[r.page_id]), hashlib.sha1(payload[r.page_id]).hexdigest()) for r in got)
    chunks = warc.read_chunks(manifest, with_data=True).where("record_id = 'urn:x-page:1'").orderBy("chunk_no").collect()
    assert len(chunks) > 2 and b"".join(c.data for c in chunks) == payload[1]
    assert chunks[0].payload_digest == hashlib.sha1(payload[1][:warc.CHUNK]).hexdigest()
    raw = b"".join(gzip.open(p.path.replace("file://", "")).read() for p in manifest.collect())
    assert raw.count(b"WARC/1.0\r\nWARC-Type: ") == len(rows) + 1  # one more inside a payload
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_archive_cut_short_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 5000)], "page_id long, url string, html string")
    path = warc.write_archives(warc.plan_records(pages), str(tmp_path / "o")).first().path.replace("file://", "")
    data = gzip.open(path).read()
    with pytest.raises(EOFError):
        list(warc.read_archive(io.BytesIO(gzip.compress(data[:-1000]))))


def article(page):
    """The article of the test pages, cut out by pattern."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inner = re.sub(r"<(?!/?b>)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")
    return " ".join(html.unescape(inner).split())


def test_articles_of_the_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_pages(pages).collect()}
    for p in pages.collect():
        if p.html and "<article>" in p.html:
            assert got[p.page_id].text == article(p.html) and got[p.page_id].n_chars == len(got[p.page_id].text)


def test_page_furniture_goes():
    long = "A sentence that is long enough to be the text of an article, with commas, and more. " * 4
    page = f"""<html><head><title>T</title><script>if (a<b) x()</script></head><body>
    <header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><nav><a>Home</a></nav>
    <div id="content"><h1>Caf&eacute; &#38; more</h1><p>{long}</p><p>Short.</p><form><input>Mail</form>
    <div class="ad-box">Buy</div><p>Line<br>two <b>bo</b>ld&nbsp;x</p></div>
    <aside>Side</aside><div class="comments"><p>{long} said a reader</p></div><footer>&copy;</footer></body></html>"""
    one = " ".join(long.split())
    assert html_text.main_text(page) == f"Café & more {one} Short. Line two bold x"
    assert html_text.main_text(f"<p>{long}") == one
    assert html_text.main_text("just text") == "just text"
    assert html_text.main_text("<article><p>Tiny.</p></article>") == "Tiny."
    assert html_text.main_text(f"<article><p class='ad'>x<p>{long}</article><div>{long}</div>") == one
    assert html_text.main_text("") == html_text.main_text(None) == html_text.main_text("<script>x</script>") == ""


def test_pages_without_article_keep_lists_tables_and_quotes():
    long = " ".join(["A sentence that is long enough to be the text of an article, with commas, and more."] * 4)
    inner = "<ul><li>One<li>Two</ul><table><tr><td>a<td>b</table><blockquote>Said.</blockquote><div>Fig.</div>"
    want = f"{long} One Two a b Said. Fig. {long}"
    for page in (f"<div><p>{long}</p>{inner}<p>{long}</p></div>",
                 f"<div><div><p>{long}</p></div><div>{inner}</div><div><p>{long}</p></div></div>"):
        far = "".join(f"<div>Far{i}</div>" for i in range(6))  # the smoothing reaches two lines
        got = html_text.main_text(f"<body>{far}{page}{far}</body>")
        assert want in got and "Far0" not in got.split(want)[0] and "Far5" not in got.split(want)[1]
    deep = "<div>" * 20_000
    assert html_text.main_text(f"{deep}x{deep}{long}") .endswith(long)


def test_extract_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (None, "u", "", "t"), (2, "u", "<p>" * 50_000 + "x", "t"),
                                   (2, "u", "<p>" * 50_000 + "x", "t")], "page_id long, url string, html string, text string")
    rows = html_text.extract_pages(pages)
    assert rows.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows.collect()) == [(0, "", 0), (1, "", 0), (2, "x", 1), (2, "x", 1)]
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def brute(ids, x, mod, k):
    out = {}
    for q in np.flatnonzero(ids % mod == 0):
        score = x @ x[q]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def recall(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hit = total = 0
    for q, best in want.items():
        mine = {v for v, _ in got.get(q, {}).values()}
        hit += len(mine & {v for v, _ in best})
        total += len(best)
        assert sorted(got.get(q, {})) == list(range(1, len(got.get(q, {})) + 1))
    return hit / total


def test_nearest_recall_on_the_tables(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    found = vectors.nearest(table).collect()
    want = brute(ids, x, 20, 20)
    assert recall(found, want) >= 0.95
    exact = {(q, v): s for q, best in brute(ids, x, 20, len(ids)).items() for v, s in best}
    assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-12 for r in found)


@pytest.mark.parametrize("lengths", ["equal", "different"])
def test_nearest_over_shards(spark, monkeypatch, lengths):
    monkeypatch.setattr(vectors, "SHARD", 700)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True) if lengths == "equal" else 1
    x[100:200] = x[100]  # equal vectors
    table = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(x)], "vec_id long, embedding array<double>, rank string")
    found = vectors.nearest(table).collect()
    want = brute(np.arange(3000), x, 20, 20)
    assert recall(found, want) >= 0.95
    assert [r.vec_id for r in sorted((r for r in found if r.query_id == 100), key=lambda r: r.rank)] == list(range(101, 121))


def test_outliers_do_not_flatten_the_others(spark):
    """Finite vectors of 1e4, 2e19 and 1e30 times the length of the others."""
    x = np.random.default_rng(2).normal(size=(2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[[7, 501, 1001]] *= np.array([[1e4], [2e19], [1e30]])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert recall(vectors.nearest(table).collect(), brute(np.arange(2000), x, 20, 20)) >= 0.95
    points, graph, _ = vectors.build_graph(x)
    assert np.isfinite(points).all() and (graph[:, 0] >= 0).all()


def test_nearest_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, None), (1, [0.0, 0.0]), (2, [float("nan"), 1.0]),
            (3, [1.0, None]), (4, []), (None, [1.0, 1.0]), (5, [0.5, 0.5]), (60, [1.0, 2.0, 3.0]), (6, [float("inf"), 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in vectors.nearest(table).collect())
    assert got == [(0, 1, 20, 1.0), (0, 2, 5, 0.5), (20, 1, 0, 1.0), (20, 2, 5, 0.5)]
    assert vectors.nearest(table.limit(0)).count() == 0


BODY = "<p>The first paragraph of the story is long enough to count as text.</p><p>And so is the second one, of course.</p>"
STORY = "The first paragraph of the story is long enough to count as text. And so is the second one, of course."


@pytest.mark.parametrize("name", [
    "content has-sidebar", "content-with-sidebar", "no-sidebar", "social-science", "side-by-side", "entry-header",
    "post-hidden-gems", "recommendation-letter", "login-guide", "navy", "content sidebar", "header"])
@pytest.mark.parametrize("around", ["{}", "<article>{}</article>"])
def test_a_name_deletes_no_page(name, around):
    for attribute in ("class", "id"):
        page = around.format(f'<div {attribute}="{name}">{BODY}</div>')
        assert html_text.main_text(f"<html><body>{page}</body></html>") == STORY


def test_named_parts_go_and_headings_stay():
    page = (f'<div class="Ad big">buy now</div><div id="wrap">{BODY}<h2 class="section-header">More of the story to be read</h2>'
            f'{BODY}<p class="comments">nice one</p><div class="comment"><div>deep</div>down</div></div>')
    assert html_text.main_text(page) == f"{STORY} More of the story to be read {STORY}"
    for unclosed in ('<li class="menu">home<p>', '<div class="ad">buy'):
        assert html_text.main_text(f"<div>{unclosed}</div><div>{BODY}</div>") == STORY


def test_an_article_is_a_hint():
    assert html_text.main_text(f"<article><p>x</p></article>{BODY}") .endswith(STORY)
    assert html_text.main_text(f"<p>Some words before it.</p><article>{BODY}</article><p>Some words after it.</p>") == STORY


def test_pages_of_the_table_with_and_without_article(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for r in rows:
        plain = re.sub(r"<(/?)(article|main)\b", r"<\1div", r.html)
        inner = re.search(r"<article\b.*</article>", r.html, re.S)
        assert html_text.main_text(r.html) == html_text.main_text(plain) != "" and inner


def test_smoothing_and_threshold_by_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(200):
        ratios = rng.exponential(50, size=int(rng.integers(1, 30)))
        want = []
        for i in range(len(ratios)):
            near = [j for j in range(len(ratios)) if abs(i - j) <= html_text.RADIUS]
            weights = np.exp(-np.array([(i - j) ** 2 for j in near]) / (2 * html_text.SIGMA ** 2))
            want.append(float((weights * ratios[near]).sum() / weights.sum()))
        got = html_text.smoothed(ratios.tolist())
        assert np.allclose(got, want)
        # Flat paragraphs in sections of their own: those with a line over the threshold are selected.
        texts = ["w" * max(1, int(r)) for r in ratios]
        smooth = np.array(html_text.smoothed([float(len(t)) for t in texts]))
        least = min(smooth.mean(), smooth.std())
        own = [i for i, s in enumerate(smooth) if s >= least]
        chosen = [t for i, t in enumerate(texts) if own and own[0] <= i <= own[-1]]
        assert html_text.main_text("".join(f"<div><p>{t}</p></div>" for t in texts)) == " ".join(chosen)
