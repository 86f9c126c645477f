"""Cross-tokenizer alignment against whole-text tokenisation and all overlaps."""

import hashlib
import random

import pytest

from volpanel.llm import token_alignment as ta

SCHEMA = "doc_id long, text string, sha string, pair int, block int, mult int, salt int, units int"


@pytest.fixture(scope="module")
def aligner():
    return ta.Aligner()


def plain(rows, aligner):
    """Whole texts, every pair of occurrences compared."""
    made, counts = [], {}
    for doc, text in rows:
        a, b = (aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)) if text else ([], [])
        pa, pb = [aligner.bytes_a[i] for i in a], [aligner.bytes_b[i] for i in b]
        if not text or b"".join(pa) != b" " + text.encode() or b"".join(pb) != b" " + text.encode():
            made.append((doc, [], [], [], []))
            continue
        spans = []
        for parts in (pa, pb):
            at, own = 0, []
            for p in parts:
                own.append((at, at + len(p)))
                at += len(p)
            spans.append(own)
        links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (x, y) in enumerate(spans[1]) if s < y and x < e]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, lo = [], 0
        for e in ends:
            groups.append(",".join(str(i) for i, (s, t) in zip(a, spans[0]) if lo <= s and t <= e) + "|" + ",".join(str(i) for i, (s, t) in zip(b, spans[1]) if lo <= s and t <= e))
            lo = e
        pairs = [(a[i], b[j]) for i, j in links]
        for p in pairs:
            counts[p] = counts.get(p, 0) + 1
        made.append((doc, a, b, groups, pairs))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return sorted(((doc, len(a), len(b), len(g), len(p), sum(counts[x] == top[x[1]] for x in p), sum(counts[x] for x in p), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for doc, a, b, g, p in made), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    words = ["the", "house", "naïve", "Straße", "don't", "  ", "x\ny", "\n", "日本語", "🙂", "12345", "<|endoftext|>", "</s>", "<0x41>", "a_b", "...", "é", "é", " ", "\t"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 40))) for _ in range(60)]
    texts += [texts[0]] * 30 + ["", None, " ", "  ", "\n", " lead", "trail ", "two  spaces", "a \n b", "has ▁ in it", "x\x00y", "\x1c z \x85 q", "word " * 3000, "x" * 5000, "﻿bom", "​zero", "a　b c", "'s 't a 's"]
    out = [(i * 2, t) for i, t in enumerate(texts)]
    return out + [out[3], (None, texts[1]), (6, "another text of document six")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, "s", 1, 2, 3, 4, 5) for d, t in rows], SCHEMA).repartition(4).cache()


def test_align(docs, rows, aligner):
    want = plain(rows, aligner)
    assert got(ta.align(docs)) == want
    assert sum(w[1] == 0 for w in want) >= 3


def test_small_blocks(docs, rows, aligner, monkeypatch):
    """Many blocks a task give the same counts."""
    monkeypatch.setattr(ta, "BLOCK_BYTES", 400)
    monkeypatch.setattr(ta, "BLOCK_UNITS", 12)
    assert ta.aligned(docs.selectExpr("text", "sha", "1 as mult")).select("block").distinct().count() > 20
    assert got(ta.align(docs)) == plain(rows, aligner)


def test_units_are_whole_texts(aligner):
    """Units give the tokens of the whole text, on random strings."""
    r = random.Random(9)
    letters = list("abe 'st1.,!\n\t-éß日▁🙂") + [" "] * 8 + ["\u00a0", "\u0301", "\u2003", "\x1d"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(1, 30))) for _ in range(3000)]
    for text in texts:
        got = aligner(ta.CUT.split(text))
        (_, n_a, n_b, n_groups, n_links, _, _, sha), = plain([(1, text)], aligner)
        if not n_a:
            assert got.sizes.min() < 0, text
            continue
        assert got.sizes.sum(axis=0).tolist() == [n_a, n_b, n_groups, n_links], text
        assert hashlib.sha256(";".join(got.groups).encode()).hexdigest() == sha, text


def test_packed_numbers():
    for numbers in ([], [0], [1, 2, 70_000, 2**31], list(range(500))):
        got, sizes = ta.unpacked([(len(numbers), ta.packed(ta.np.array(numbers, ta.np.int64)))] * 2)
        assert got.tolist() == numbers * 2 and sizes.tolist() == [len(numbers)] * 2


def test_empty_and_text_ids(spark, aligner):
    assert ta.align(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [("b", "x y"), ("a", None), ("c", "x y")]
    assert got(ta.align(spark.createDataFrame(rows, "doc_id string, text string"))) == plain(rows, aligner)


def test_whole_table(spark, aligner):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    short = [(d, t) for d, t in rows if len(t or "") < 3000]
    assert got(ta.align(docs.where("length(text) < 3000 or text is null"))) == plain(short, aligner)
