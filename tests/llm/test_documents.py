"""The operators on documents against plain versions, on planted and odd rows."""

import hashlib
import itertools
import random

import llm_brute as brute
import numpy as np
import pytest

from volpanel.llm import decontamination, fingerprint, line_dedup, mphf, packing, pii, simhash, substring_dedup, toxicity
from volpanel.llm.fmindex import FMIndex

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, _gone int, words string"


def prose(r, n):
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    texts = [prose(r, r.randint(1, 120)) for _ in range(60)]
    passage, line = prose(r, 70), "  The same LINE stands in many documents \t"
    for k in range(20):
        texts.append(prose(r, 30) + "\n" + (line.upper() if k % 3 else line) + "\n" + passage + " " + prose(r, 10))
    near = prose(r, 400).split(" ")
    for k in range(12):
        own = list(near)
        own[k * 7] = "changed"
        texts.append(" ".join(own))
    texts += [texts[5]] * 9 + ["", None, " \t\n ", "one", "\n\n", "word " * 3000, "ab cd ef gh " * 400, "x" * 50_000, "Ä" * 25 + "\nÄ" + "a" * 19]
    out = [(i * 3, t) for i, t in enumerate(texts)]
    return out + [(5 * 3, texts[5])]  # a repeated row


@pytest.fixture(scope="module")
def docs(spark, rows):
    made = [(d, t, "en", "s", None if t is None else len(t), 7, 1, "w") for d, t in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_dedup(docs, rows, none):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.dedup_report(docs).collect()}
    want = brute.line_dedup(rows)
    assert got == want and sum(w[1] for w in want.values()) > 15
    assert line_dedup.dedup_report(none).count() == 0


def test_line_dedup_keeps_columns(docs, rows):
    got = line_dedup.dedup(docs)
    assert got.columns == docs.columns
    want = brute.line_dedup(rows)
    for r in got.collect():
        assert hashlib.sha256((r.text or "").encode()).hexdigest() == want[r.doc_id][2]
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_line_dedup_without_id(spark):
    line = "a line of more than twenty characters"
    df = spark.createDataFrame([(1, line), (2, line), (3, line), (None, line)], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup.dedup_report(df).collect()} == {1: 1, 2: 1, 3: 0, None: 0}


def test_line_dedup_text_ids(spark):
    line = "a line of more than twenty characters"
    df = spark.createDataFrame([("b", line), ("a", line), ("c", line + "\nx"), (None, line)], "doc_id string, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup.dedup_report(df).collect()} == {"a": 1, "b": 1, "c": 0, None: 0}
    assert {r.doc_id: r.text for r in line_dedup.dedup(df).collect()} == {"a": "", "b": "", "c": line + "\nx", None: line}


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64))
    parts = mphf.build(keys)
    assert sorted(mphf.Lookup(parts)(keys)) == list(range(len(keys)))
    assert len(parts["bits"]) * 64 < 6 * len(keys)
    assert mphf.Lookup(mphf.build(keys[:0]))(keys[:3]).tolist() == [-1, -1, -1]


def test_simhash_groups(docs, rows, none):
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_groups(docs).collect()}
    fps = {d: brute.fingerprint(t) for d, t in rows}
    assert {d: g[0] for d, g in got.items()} == fps
    assert {d: g[1] for d, g in got.items()} == brute.components(fps)
    assert simhash.near_groups(none).count() == 0


def test_simhash_keeps_rows_without_id(spark):
    df = spark.createDataFrame([(3, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "a b c d"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_groups(df).collect()), key=str)
    fp = brute.fingerprint("a b c d")
    assert got == sorted([(3, fp, 1), (1, fp, 1), (None, fp, None), (None, fp, None), (None, 0, None)], key=str)
    assert simhash.dedup(df).count() == 4


def test_simhash_dedup_keeps_one(docs, rows):
    comp = brute.components({d: brute.fingerprint(t) for d, t in rows})
    got = simhash.dedup(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {d for d, c in comp.items() if d == c}


def test_simhash_links_in_crowded_entries(spark):
    """A dense ball of fingerprints, with entries dealt to a grid of small blocks."""
    r = np.random.default_rng(5)
    centre = int(r.integers(0, 2**63))
    fps = sorted({centre ^ sum(1 << int(b) for b in r.choice(64, int(r.integers(0, 6)), replace=False)) for _ in range(400)} | {int(x) for x in r.integers(0, 2**63, 200)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(df, entry=64).collect()
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in edges:
        a, b = find(e.a), find(e.b)
        root[max(a, b)] = min(a, b)
    got = {}
    for f in signed:
        got.setdefault(find(f), set()).add(f & (2**64 - 1))
    want = {}
    for k, c in brute.components(dict(enumerate(fps))).items():
        want.setdefault(c, set()).add(fps[k])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 500)] + [(7, 3)]
    got = {r.v: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {k: 3 for k in [7, *range(200, 500)]}


@pytest.mark.parametrize("crowded", [2, substring_dedup.CROWDED])
def test_substring_dedup(docs, rows, none, crowded):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.report(docs, crowded=crowded).collect()}
    assert got == brute.substring_dedup(list(dict(rows).items()))
    assert substring_dedup.report(none).count() == 0


@pytest.mark.parametrize("crowded,local", [(2, 1), (1024, 1), (1024, 3)])
def test_substring_dedup_apart(docs, rows, crowded, local):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.report(docs, crowded=crowded, local=local).collect()}
    assert got == brute.substring_dedup(list(dict(rows).items()))


def test_substring_dedup_edges_of_a_hot_passage(spark):
    """A passage shared by all, amid each document's own words: no shard gets a row per document."""
    r = random.Random(12)
    passage = prose(r, 50)
    made = [(k, f"{prose(r, 30)} {passage} {prose(r, 30)}") for k in range(600)]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(2)
    report = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in substring_dedup.report(df).collect()}
    assert report == brute.substring_dedup(made)
    shards, window = 16, substring_dedup.WINDOW
    segs = substring_dedup.segment_rows(df, shards, window).cache()
    of_mini = segs.where(segs.kind.isin(substring_dedup.FIRST, substring_dedup.TWICE)).groupBy("mini").count().agg({"count": "max"}).first()[0]
    assert of_mini <= 2 * substring_dedup.LOCAL
    resolved = segs.groupBy("shard").applyInArrow(substring_dedup.resolver(substring_dedup.CROWDED), substring_dedup.RESOLVED)
    sent = substring_dedup.asked_words(df, resolved.where(resolved.kind != substring_dedup.REPEAT), shards, window)
    copies = sent.where(sent.kind == substring_dedup.DEAL).groupBy("words").count().agg({"count": "max"}).first()[0]
    assert copies <= substring_dedup.shuffle_parts(spark) < 100


def test_substring_dedup_without_id(spark):
    t = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(None, t), (1, t), (2, t)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.report(df).collect()} == {None: 0, 1: 0, 2: 30}


def test_fm_index_statistics():
    r = np.random.default_rng(2)
    seq = np.append(r.integers(0, 5, 300), 5)
    rows = np.concatenate([r.integers(-1, 5, (20, 40)), seq[10:50][None, :]])
    length, lo, hi = FMIndex(seq, 12).statistics(rows, np.full(21, 40))
    body = seq[:-1].tolist()
    for row, own, a, z in zip(rows.tolist(), length.tolist(), lo.tolist(), hi.tolist()):
        for i in range(40):
            m = 0
            while m < 12 and i + m < 40 and any(body[j : j + m + 1] == row[i : i + m + 1] for j in range(len(body))):
                m += 1
            assert own[i] == m
            if m:
                assert z[i] - a[i] == sum(body[j : j + m] == row[i : i + m] for j in range(len(body)))


def test_decontamination(spark, docs, rows, none):
    r = random.Random(9)
    texts = dict(rows)
    items = [(1, " ".join(texts[180].split()[5:40])), (2, prose(r, 30)), (3, "one"), (4, ""), (5, None), (6, prose(r, 3)), (7, "word word word word word word"), (1, "one")]
    some = texts[183].split()
    items.append((8, " ".join([*some[:20], "other", *some[21:40]])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(docs.dropDuplicates(["doc_id"]), bench)
    pairs = [(r.doc_id, r.item_id, r.n_item, r.n_found) for r in got.collect()]
    want = [p for item in items for p in brute.contained(list(texts.items()), [item])]
    assert sorted(pairs) == sorted(want) and len(want) == 5
    kept = decontamination.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(texts) - {p[0] for p in want}
    assert decontamination.contaminated(none, bench).count() == 0
    assert decontamination.contaminated(docs, bench.where("false")).count() == 0


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    got = packing.pack(packing.pieces(docs), group_pieces=40).collect()
    tok = Tokenizer.from_file(packing.default_tokenizer())
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == brute.pieces(rows, tok)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 1
    assert packing.pack(packing.pieces(none)).count() == 0


def test_tokenizer_word_by_word():
    from tokenizers import Tokenizer

    texts = ["Don't stop, it's 3.14!! <|endoftext|> x", "hello <|endoftext|> world", "a<|startoftext|>b<|ENDOFTEXT|>é<|endoftext", "É <|endoftext|>é", "É́clair naïve space ﬁ 日本 🙂 tab\tnew\nline", "'s 'll WE'RE a'b", "İstanbul ß ǅ", ""]
    tok = Tokenizer.from_file(packing.default_tokenizer())
    enc = packing.Encoder(packing.default_tokenizer())
    for text, got in zip(texts, enc(texts)):
        assert got.tolist() == tok.encode(text, add_special_tokens=False).ids


def test_local_search_empties_bins():
    sizes = [6, 6, 5, 5, 4, 4]  # three bins of 10 exist
    bins = packing.improve([[0, 4], [1], [2], [3, 5]], sizes, 10)
    assert sorted(sum(sizes[i] for i in b) for b in bins) == [10, 10, 10]


def test_local_search_ends_in_a_local_optimum():
    r = random.Random(11)
    for _ in range(40):
        room = r.choice([12, 50, 400])
        sizes = [r.randint(1, room - 1) if r.random() < 0.6 else r.randint(1, max(1, room // 6)) for _ in range(r.randint(2, 60))]
        start = packing.best_fit(sizes, room)
        bins = packing.improve(start, sizes, room)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and len(bins) <= len(start)
        fill = [sum(sizes[i] for i in b) for b in bins]
        assert max(fill) <= room
        for a in range(len(bins)):
            for b in range(len(bins)):
                if a == b or fill[a] > fill[b] or fill[b] == room:
                    continue
                own = lambda k, n: [sum(sizes[i] for i in c) for c in itertools.combinations(bins[k], n)]
                steps = [g - t for n, m in ((1, 0), (1, 1), (2, 1), (1, 2)) for g in own(a, n) for t in own(b, m)]
                assert not any(0 < s <= room - fill[b] for s in steps)


def test_packing_of_pieces_that_cannot_be_combined(spark):
    cut = spark.range(300).selectExpr("id as doc_id", "id as row_id", "0 as piece", "0L as start", "cast(1500 + id % 100 as long) as length", "0L as ids_crc32")
    got = packing.pack(cut, group_pieces=20)
    assert got.select("sequence_id").distinct().count() == got.count() == 300


def test_substring_dedup_repeated_and_text_ids(spark):
    r = random.Random(5)
    passage, tail = prose(r, 30), prose(r, 90)
    rows = [(1, passage + " end"), (1, "other start " + passage), (2, passage + " " + tail), (2, passage + " " + tail), (3, tail), (None, tail)]
    for kind, ids in (("long", {}), ("string", {1: "a", 2: "b", 3: "c", None: None})):
        df = spark.createDataFrame([(ids.get(d, d), t) for d, t in rows], f"doc_id {kind}, text string")
        got = sorted(((x.doc_id, x.n_words, x.n_removed) for x in substring_dedup.report(df).collect()), key=str)
        # of the two texts of document 1 one is first, the other loses the passage; equal rows share their result
        counts = {(len(t.split()), gone) for t, gone in ((rows[0][1], 30), (rows[1][1], 30))}
        first = [g for g in got if g[0] == ids.get(1, 1)]
        assert sorted(g[2] for g in first) == [0, 30] and {(g[1], 30) for g in first} == counts
        assert [g for g in got if g[0] == ids.get(2, 2)] == [(ids.get(2, 2), 120, 30)] * 2
        assert [g for g in got if g[0] == ids.get(3, 3)] == [(ids.get(3, 3), 90, 90)] and (None, 90, 0) in got


def test_fingerprint_report(docs, rows, none):
    texts = sorted({(d, t or "") for d, t in rows})
    got = {r.doc_id: r for r in fingerprint.report(docs.dropDuplicates(["doc_id"])).collect()}
    fps = [int(r.fingerprint, 16) for r in got.values()]
    assert len(got) == len(texts)
    for i, (d, t) in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[1][:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == 1 - (int(r.fingerprint, 16) ^ int(got[after[0]].fingerprint, 16)).bit_count() / 64
        assert r.near_edited == 1 - (int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).bit_count() / 64
        assert r.edited_known == any((int(r.edited_fingerprint, 16) ^ f).bit_count() <= 3 for f in fps)
    same = {}
    for d, t in texts:
        assert same.setdefault(t, got[d].fingerprint) == got[d].fingerprint
    assert fingerprint.report(none).count() == 0


def test_fingerprints_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "x y z")] * 3 + [(2, "q r")], "doc_id long, text string")
    got = [r.doc_id for r in fingerprint.report(df).collect()]
    assert sorted(got) == [1, 1, 1, 2]


def test_block_tables_find_all(spark):
    r = np.random.default_rng(8)
    base = [int(x) for x in r.integers(-(2**63), 2**63 - 1, 60)]
    near = [(b & (2**64 - 1)) ^ sum(1 << int(k) for k in r.choice(64, n, replace=False)) for b in base for n in (1, 3, 4, 9)]
    asked = [n - (1 << 64) if n >> 63 else n for n in near]
    df = spark.createDataFrame([(b,) for b in base], "fp long")
    got = {x.fp for x in fingerprint.known(spark.createDataFrame([(a,) for a in asked], "fp long"), df).collect()}
    assert got == {a for a in asked if any(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for b in base)}


ODD = ["call me 030-555-1234 now", "mail bob (at) site (dot) com x", "order 123-456-7890", "a@b.c@d.e", "+1 (555) 123-4567 999", "1.2.3.4.5.6.7.8 999.1.1.1 0000.1.1.01",
       "4111 1111 1111 1111", "card 4111.1111.1111.1111", "9" * 30_000, "a" * 100_000, None, "", "x@y.zz" * 300, "🙂 é a_b@c-d.e-f.gg", "+49 30 1234567 +49-30-1234567", "to at thnthe. Esenes"]


def test_pii(spark, docs, rows, none):
    model = pii.fit(spark)
    made = [(i, t) for i, t in enumerate(ODD)] + [(1000 + d, t) for d, t in dict(rows).items()]
    got = pii.report(spark.createDataFrame(made, "doc_id long, text string"), model).collect()
    texts = dict(made)
    assert len(got) == len(made)
    for r in got:
        base = brute.pii_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        assert {(k, str(a), str(z)) for k, a, z in base} <= set(spans) and r.n_added == len(spans) - len(base)
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), int(x[1])))
    added = {r.doc_id: r.n_added for r in got}
    assert added[0] == 1 and added[1] == 1 and added[2] == 0 and added[15] == 0
    assert pii.report(none, model).count() == 0


def test_toxicity_fit_is_that_of_rows_at_hand(spark):
    r = random.Random(12)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    texts = [" ".join(r.choice(vocab) for _ in range(r.randint(0, 60))) + (" vilewordy" * r.randint(1, 3) if k % 4 == 0 else "") for k in range(160)] + ["", None]
    for ids, kind in ((list(range(162)), "long"), ([f"d{k:03}" for k in range(162)], "string")):
        toxic = [int(k % 4 == 0) for k in range(160)] + [0, 1]
        df = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts)] + [(ids[0], "~ a larger text of the same document", 2)], f"doc_id {kind}, text string, words int").repartition(5)
        labels = spark.createDataFrame([(i, t) for i, t in zip(ids, toxic)] + [(ids[3], None), (None, 1)], f"doc_id {kind}, toxic int")
        model = toxicity.fit(df, labels)
        assert model == toxicity.fit_rows(ids, texts, toxic) and model["threshold"] < 1
        assert toxicity.score(df, model).where("is_toxic").count() >= 38


def test_toxicity_chain(spark):
    r = random.Random(4)
    bad = ["zorgly", "vexnata"]
    made, labels = [], []
    for i in range(600):
        words = prose(r, 40).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(r.randint(1, 4)):
                words.insert(r.randint(0, len(words)), r.choice(bad).upper() + "!")
        made.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic) if i < 400 else None))
    made += [(900, None), (901, ""), (902, "zorgly " * 5000), (None, "plain")]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert model["oof_f1"] > 0.97
    flagged = {x.doc_id for x in toxicity.score(docs, model).collect() if x.is_toxic}
    assert flagged == {i for i in range(0, 600, 5)} | {902}
    kept = toxicity.keep_clean(docs.withColumn("is_toxic", docs.doc_id), model)
    assert {x.doc_id for x in kept.collect()} == {i for i, _ in made} - flagged
    empty = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.keep_clean(docs, empty).count() == len(made)


def test_noise_labels_reject_nothing():
    for seed in range(4):
        r = random.Random(seed)
        vocab = [prose(r, 1) + str(k) for k in range(3000)]
        texts = [" ".join(r.choice(vocab) for _ in range(40)) for _ in range(400)]
        model = toxicity.fit_rows(list(range(400)), texts, [r.random() < 0.25 for _ in texts])
        scores = toxicity.Scorer(model).scores([" ".join(r.choice(vocab) for _ in range(40)) for _ in range(200)])
        assert (scores[:, -1] > model["threshold"]).mean() <= 0.01 and (model["oof_f1"] or 0) < 0.2


def test_out_of_fold_predictions_are_not_own(spark):
    """With pure noise, in-fold predictions would separate the rows; out-of-fold ones must not."""
    r = np.random.default_rng(0)
    x, y = r.normal(size=(200, 150)), (r.random((200, 1)) < 0.5).astype(float)
    _, oof = toxicity.fit_chain(x, y, np.arange(200) % 5)
    assert abs(np.corrcoef(oof[:, 0], y[:, 0])[0, 1]) < 0.25


def test_line_dedup_tasks_give_memory_back(monkeypatch):
    """Workers live on beside the next stage's: the report's and the hashing tasks used to keep what they had freed."""
    import pyarrow as pa

    from volpanel.llm import line_dedup

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return lambda batch: list(run(iter([batch])))

    calls = []
    monkeypatch.setattr(line_dedup, "release_memory", lambda: calls.append(1))
    run = line_dedup.line_hashes(Docs(), 3)
    rows = run(pa.RecordBatch.from_pydict({line_dedup.KEY: pa.array([1, 2]), "text": pa.array(["a long line\nb", "a long line"])}))
    assert sum(b.num_rows for b in rows) == 2 and calls == [1]


def test_encoder_learns_pieces_not_words():
    """A word and its marks used to be learned anew for every mark behind it."""
    from volpanel.llm.packing import Encoder, default_tokenizer

    encoder = Encoder(default_tokenizer())
    texts = ["Sea, sea. sea; SEA! it's sea's ''s 42", "sea it's"]
    got = [a.tolist() for a in encoder(texts)]
    assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert set(encoder.words) == {b"sea", b",", b".", b";", b"!", b"it", b"'s", b"''", b"s", b"4", b"2"}
