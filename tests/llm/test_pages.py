"""The operators on pages, and the pipeline."""

import base64
import hashlib
import io
import random

import numpy as np
import pytest

from volpanel.llm import gbdt, html_extract, warc

ROWS = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\nc", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "v", "é" * 70_000), (6, "w", "<p>x</p>"), (None, "n", "<p>x</p>"), (7, "d", "WARC/1.1\r\n\r\n" * 50), (2, "http://b/\nc", "<p>x</p>"), (1, "again", "<p>x</p>")]


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, u, h in rows:
        data = (h or "").encode()
        refers = first[h or ""] if i is not None and first[h or ""] != i else None
        out.append((i, u, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [64, 1000, 8 << 20])
def test_warc_round_trip(spark, split):
    rows = ROWS + [(100 + k, f"u{k}", f"<p>{k % 7}</p>" * (k % 40)) for k in range(200)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha string").repartition(3)
    got = warc.read(warc.write(df), split).collect()
    assert sorted([(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(rows)
    texts = {(r[0], r[1]): (r[2] or "").encode() for r in rows}
    assert all(bytes(r.payload) == texts[r.page_id, r.url] for r in got if r.record_type == "response")


def test_warc_small_payloads_are_responses(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    got = warc.read(warc.write(df, min_bytes=9)).collect()
    assert all(r.record_type == "response" for r in got)


def test_warc_empty(spark):
    assert warc.read(warc.write(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_reader_owns_records_that_start_inside():
    r = random.Random(1)
    data = b"".join(warc.member(warc.record(k, "u", bytes(r.randrange(256) for _ in range(r.randint(0, 900))) + b"\x1f\x8b\x08\x00" * 5, "D", None)) for k in range(40))
    for split in (7, 100, 1013, len(data)):
        ids = [x["fields"]["page-id"] for s in range(0, len(data), split) for x in warc.records_of(io.BytesIO(data), s, min(s + split, len(data)), len(data))]
        assert ids == [str(k) for k in range(40)]
    assert list(warc.records_of(io.BytesIO(data[:-5]), len(data) - 40, len(data) - 5, len(data) - 5)) == []  # a cut member is no record


@pytest.fixture(scope="module")
def model():
    return html_extract.fit()


def test_extraction_on_held_out_pages(model):
    right = total = 0
    for nodes, x, _ in html_extract.generated(200, 77):
        want = [n.text for n in nodes if n.text is not None and n.label]
        right += html_extract.decode(nodes, gbdt.predict(model, x)) == want
        total += 1
    assert right / total > 0.95


def test_extraction_rows(spark, model):
    page = "<html><head><title>t</title><script>if(a<b){'</p>'}</script></head><body><nav><a href=/>Home</a> <a href=/x>About us</a></nav><article><h1>A &amp; B&nbsp;&copy</h1><p>First  <b>bo</b>ld\n text, it goes on. And on.<p>Second one is here, as well.</article><div class=comments><p>Nice one, thanks.</p></div><footer>&copy; me</footer>"
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<<<>>> <p"), (5, "x", "<div>" * 3000 + "deep"), (1, "u", page)]
    got = html_extract.extract(spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string"), model).collect()
    assert len(got) == 6
    one = [r for r in got if r.page_id == 1]
    assert [r.text for r in one] == ["A & B © First bold text, it goes on. And on. Second one is here, as well."] * 2
    assert all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got if r.page_id in (2, 3)} == {2: "", 3: ""}
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0


def test_decoding_is_consistent():
    root = html_extract.Node("html", None)
    a, b = html_extract.Node("div", root), html_extract.Node("div", root)
    x, y = html_extract.Node("#text", a), html_extract.Node("#text", b)
    x.text, y.text = "x", "y"
    import numpy as np

    nodes = [root, a, x, b, y]
    # a block alone can't outweigh a dropped parent; a strong one pulls its ancestors in
    assert html_extract.decode(nodes, np.array([1.0, -3.0, 2.0, -1.0, 4.0])) == ["y"]
    assert html_extract.decode(nodes, np.array([-9.0, -3.0, 2.0, -1.0, 4.0])) == []


@pytest.mark.parametrize("n", [5, 60, 61, 300])
def test_sibling_features_at_any_number_of_siblings(n):
    page = "<div>" + "".join(f"<{t}>{'w ' * (k % 9)}<a href=x>{'l' * (k % 5)}</a>e</{t}>" for k in range(n) for t in ["p" if k % 3 else "pre"]) + "</div>"
    nodes, x = html_extract.feature_rows(html_extract.parse(page)[0])
    kids = nodes[1].kids
    at = {id(node): r for r, node in enumerate(nodes)}
    assert len(kids) == n
    for i, k in enumerate(kids):
        v = x[at[id(k)]]
        before, after = kids[i - 1] if i else None, kids[i + 1] if i + 1 < n else None
        assert v[13] == np.float32(sum(o.tag == k.tag for o in kids) / n) and v[23] == np.float32(i / n)
        assert v[15] == np.float32(np.log1p(before.size) if before else -1) and v[16] == np.float32(np.log1p(after.size) if after else -1)
        assert v[17] == np.float32(before.links / before.size if before else 0) and v[18] == np.float32(after.links / after.size if after else 0)


def test_deep_elements_close_themselves():
    for depth in (50, 1000):
        root, blocks = html_extract.parse("<section>" * depth + "in" + "</section>" * (depth - 1) + "out")
        assert [(b.text, b.depth) for b in blocks] == [("in", depth + 1), ("out", 2)]


def test_extraction_on_pages_with_hundreds_of_siblings(model):
    pages = html_extract.generated(500, 78)
    long = [(nodes, x) for nodes, x, _ in pages if max(len(n.kids) for n in nodes) > 60]
    assert len(long) > 30
    right = sum(html_extract.decode(nodes, gbdt.predict(model, x)) == [n.text for n in nodes if n.text is not None and n.label] for nodes, x in long)
    assert right / len(long) > 0.9


SENTENCES = [f"This is sentence {k} of the article, which goes on for a while. It says something more, and then it ends." for k in range(6)]


@pytest.mark.parametrize("tag", "button select svg math object audio video canvas noscript template".split())
def test_unclosed_elements_keep_the_article(model, tag):
    body = "".join(f"<p>{t}</p>" for t in SENTENCES)
    for page in (f"<body><nav><a href=/>Home</a></nav><div class=bar><{tag}>x</div><article><h1>A title</h1>{body}</article>", f"<body><{tag}><article><h1>A title</h1>{body}</article><footer>&copy; me</footer></body>"):
        root, blocks = html_extract.parse(page)
        assert [b.text for b in blocks if b.size > 50] == SENTENCES
        if tag != "template" or "bar" in page:  # in an open template nothing is shown
            assert " ".join(SENTENCES) in html_extract.extract_batch(model, [page])[0]


def test_formulas_and_fallback_text_are_judged(model):
    first = "".join(f"<p>{t}</p>" for t in SENTENCES)
    page = f"<body><article><h1>A title</h1>{first}<p>The law is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> in short, as we know.</p><object><p>{SENTENCES[0]}</p></object><svg><path d='M0'/><path d='M1'/></svg><p>{SENTENCES[1]}</p></article><button>Send now</button><select><option>One<option>Two</select><footer>&copy; me</footer>"
    want = " ".join(["A title", *SENTENCES, "The law is E=m in short, as we know.", SENTENCES[0], SENTENCES[1]])
    assert html_extract.extract_batch(model, [page])[0] == want


def test_long_attributes_and_empty_comments():
    pages = {
        f'<p data-x="{"a" * 9000} > b">Hello world</p>': ["Hello world"],
        "<p>before</p><!--><p>after</p>": ["before", "after"],
        "<p>before</p><!---><p>after</p><!-- x --!><p>end</p><!-- open": ["before", "after", "end"],
        "<p>a</p><!-- <p>b</p> --><p title='>'>c</p>": ["a", "c"],
    }
    for page, want in pages.items():
        assert [n.text for n in html_extract.walk(html_extract.parse(page)[0]) if n.text is not None] == want
