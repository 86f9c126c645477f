"""MinHash near-dedup against all pairs of whole sets."""

import random

import llm_brute as brute
import numpy as np
import pytest

from volpanel.llm import minhash_tensor as mt

SCHEMA = "doc_id long, text string, id long, key int, n string, place int, root long, _id int"


def plain(rows, shingle=2, per_cent=80):
    """(doc_id, text) -> sorted (doc_id, n, component, kept)."""
    sets = []
    for _, text in rows:
        w = brute.WORD.findall(brute.lower(text or ""))
        sets.append({" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else ({" ".join(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= per_cent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        comp = None if doc is None else least[find(i)]
        out.append((doc, len(sets[i]), comp, comp is None or comp == doc))
    return sorted(out, key=repr)


def prose(r, n, letters="abcdefgh"):
    return [r.choice(letters) + r.choice(letters) + r.choice(letters) for _ in range(n)]


def edited(r, words, share):
    return [r.choice("xyz") * 3 + str(r.random())[:5] if r.random() < share else w for w in words]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    texts = [" ".join(prose(r, r.randint(1, 60))) for _ in range(80)]
    for share in (0.01, 0.03, 0.05, 0.06):  # groups around the limit, one with many members
        base = prose(r, 150)
        texts += [" ".join(edited(r, base, share)) for _ in range(60 if share == 0.05 else 15)]
    texts += [texts[3]] * 7 + [texts[3].upper()] + ["", None, " \t\n", "one", "ONE", "two", "a b", "b a", "a b a b a b", "word " * 4000, "é ü x", "É ü x"]
    ids = list(range(1, 2 * len(texts), 2))
    r.shuffle(ids)
    out = list(zip(ids, texts))
    return out + [out[5], (out[5][0], "quite another text of the same document"), (None, texts[3]), (None, None), (None, "only here and nowhere else")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, 4, 1, "n", 2, 9, 0) for d, t in rows], SCHEMA).repartition(5).cache()


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def test_near_groups(docs, rows):
    want = plain(rows)
    assert got(mt.near_groups(docs)) == want
    assert len({w[2] for w in want}) < len(rows) - 40


def test_cells_lose_no_link(spark, docs, rows, monkeypatch):
    """Cells of any size find all links among the members of table entries."""
    classes = mt.signatures(docs).where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(mt.F.min("doc_id").alias("id"), mt.F.first("subs").alias("subs")).cache()
    entries = mt.table_entries(classes).withColumn("root", mt.F.col("id")).cache()
    of = {}
    for r in entries.collect():
        of.setdefault(r.key, []).append(r)
    assert max(map(len, of.values())) > 20
    for members in of.values():
        assert sorted(m.place for m in members) == list(range(len(members))) and {m.first for m in members} == {min(m.id for m in members)}
    want = {(a.id, b.id) for members in of.values() for a in members for b in members if a.id < b.id}

    sets = mt.whole_sets(docs, classes.select("id", "n", "s1", mt.F.col("id").alias("doc"))).cache()
    h = {r.id: set(r.h) for r in sets.collect()}

    def groups(pairs):
        root = {i: i for i in h}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        return {i: find(i) for i in h}

    linked = groups((a, b) for a, b in want if 100 * len(h[a] & h[b]) >= 80 * len(h[a] | h[b]))
    for cell, columns, stars, bucket in ((5, 7, 1, 300), (1024, 2048, 12, 2_000_000), (1024, 2048, 10_000, 5_000)):
        monkeypatch.setattr(mt, "COLUMNS", columns)
        monkeypatch.setattr(mt, "STARS", stars)
        monkeypatch.setattr(mt, "BUCKET", bucket)
        got = [tuple(p) for p in mt.group_links(entries, sets, cell).collect()]
        assert all(100 * len(h[a] & h[b]) >= 80 * len(h[a] | h[b]) or linked[a] == linked[b] for a, b in got)
        assert groups(got) == linked


def test_dedup_keeps_columns(docs, rows):
    out = mt.dedup(docs)
    assert out.columns == docs.columns
    want = sorted((d for d, _, _, kept in plain(rows) if kept), key=repr)
    kept = sorted((r.doc_id for r in out.collect()), key=repr)
    assert set(kept) == set(want)


def test_empty_and_text_ids(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mt.near_groups(none).count() == 0 and mt.dedup(none).count() == 0
    df = spark.createDataFrame([("b", "x y z"), ("a", "x  Y z"), ("c", "")], "doc_id string, text string")
    assert got(mt.near_groups(df)) == [("a", 2, "a", True), ("b", 2, "a", False), ("c", 0, "c", True)]


def test_sub_keys_meet(rows):
    """At the limit nearly all pairs share a sub-key of each collection; unlike sets don't."""
    draw = np.random.default_rng(1)
    missed = met = 0
    for _ in range(200):
        common, a, b = (draw.integers(1, 1 << 62, n).astype(np.uint64) for n in (80, 10, 10))
        one, two = mt.sub_keys(np.append(common, a)), mt.sub_keys(np.append(common, b))
        missed += not ((one == two)[: mt.SIDE].any() and (one == two)[mt.SIDE :].any())
        far = mt.sub_keys(np.append(common[:5], draw.integers(1, 1 << 62, 90).astype(np.uint64)))
        met += bool((one == far)[: mt.SIDE].any() and (one == far)[mt.SIDE :].any())
    assert missed <= 1 and met <= 1


def test_same_result_in_other_layouts(spark, docs):
    one = got(mt.near_groups(docs))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(mt.near_groups(docs.repartition(1))) == one
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(mt.near_groups(docs)) == plain(rows)
