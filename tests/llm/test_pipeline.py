"""The pipeline stage by stage against plain versions, and the registration."""

import llm_brute as brute
import corpus_pipeline
import pytest

import __spark_entry__ as entry
from volpanel.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, f in corpus_pipeline.STAGES:
        got = f(spark, docs, SF).cache()
        if f is not corpus_pipeline.STAGES[-1][1]:
            assert got.columns == docs.columns
        out.append(got.collect())
        docs = got
    return out


def test_toxicity_stage(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    clean = [d for d, t in labels.items() if not t]
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)
    rows = [(r.doc_id, r.text, labels[r.doc_id]) for r in stages[0] if r.doc_id in labels]
    model = toxicity.fit_rows(*zip(*sorted(rows)))
    scorer = toxicity.Scorer(model)
    gone = {r.doc_id for r, p in zip(stages[0], scorer.scores([r.text for r in stages[0]])) if p[-1] > scorer.cut}
    assert kept == {r.doc_id for r in stages[0]} - gone


def test_line_stage(stages):
    import hashlib

    want = brute.line_dedup([(r.doc_id, r.text) for r in stages[1]])
    assert {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in stages[2]} == {d: w[2] for d, w in want.items()}


def test_simhash_stage(stages):
    comp = brute.components({r.doc_id: brute.fingerprint(r.text) for r in stages[2]})
    assert {r.doc_id for r in stages[3]} == {d for d, c in comp.items() if d == c}


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {p[0] for p in brute.contained([(r.doc_id, r.text) for r in stages[3]], items)}
    assert {r.doc_id for r in stages[4]} == {r.doc_id for r in stages[3]} - hit


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    from volpanel.llm import packing

    tok = Tokenizer.from_file(packing.default_tokenizer())
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in stages[5]} == brute.pieces([(r.doc_id, r.text) for r in stages[4]], tok)


def test_run_on_odd_rows_and_empty_tables(spark, tmp_path):
    """The stages in a row over nulls, repeated rows, empty and long texts, clashing columns, and over no rows at all."""
    toxic = "some vilewordy and vilewordy things said here"
    texts = [toxic + f" number {i} of them" if i % 4 == 0 else f"a quiet text about gardens and rivers, number {i}, {'x' * (i % 7)} and more of {i * 31}" for i in range(80)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(500, None, None, None, None), (501, "", "en", "s", 0), (502, " \n\t ", "en", "s", 4), (None, "a text without an id that nothing else holds", "en", "s", 5), (503, "long " * 9000, "en", "s", 45000), rows[1]]
    schema = "doc_id long, text string, lang string, source string, n_chars int, _key int, row_id long, component_id long"
    labels = [(i, 1, int(i % 4 == 0)) for i in range(80)] + [(None, 1, 1), (3, None, None)]
    items = [(1, texts[5]), (2, None), (3, ""), (None, "an item without an id that no document holds here")]
    for name, docs in (("odd", [(*r, 1, 2, 3) for r in rows]), ("none", [])):
        sf = f"{tmp_path}/{name}"
        spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame(labels if docs else [], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame(items if docs else [], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        got = corpus_pipeline.run(spark, sf).collect()
        if not docs:
            assert got == []
            continue
        kept = {r.doc_id for r in got}
        assert not kept & set(range(0, 80, 4)) and 5 not in kept  # toxic ones, and the one that holds a test item
        assert {500, 501, 502} & kept == {500}  # empty texts are one group
        assert None in kept and 503 in kept and {i for i in range(80) if i % 4 and i != 5} <= kept
        assert sum(r.length for r in got if r.doc_id == 503) > 2048 and all(r.length <= 2048 for r in got)


def test_registered():
    names = entry.queries()
    assert [next(n for n in names if n.startswith(f"op{k}_")) for k in range(1, 14)] and "pipeline" in names
