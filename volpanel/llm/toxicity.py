"""Toxicity by a classifier chain of linear models.

A chain predicts its categories one after the other: the model of category k reads the lexical
features and the probabilities of categories 1..k-1.  While fitting, those earlier probabilities
are out-of-fold predictions (each row is predicted by models that did not see it), so a later model
never learns from an earlier one's memory of its own rows.

Fitting takes a bounded sample of labelled documents (``SAMPLE_ROWS``, chosen by a hash of the id).  The scan, the
join, the counting of words and of features run in parallel; what reaches a fitting task is a row of feature counts
per document.  There is one fitting task for the shipped chain and one for each held-out fold.  Scoring runs over
every row of the table, whole texts, without a shuffle.

Features are words and character n-grams (A-Z lower-cased) that are over-represented in labelled
toxic rows, as log(1 + count), found from the sample itself; no word list is built in.

Defined cases: null or empty text has no features and gets the base rate; a row without a label is
only scored; a label row without a document, or with a null flag, is ignored; repeated rows are
scored one by one, and of rows that repeat a doc_id the fit takes the smallest text; doc_id may be of any type; an empty or one-class sample gives a model that accepts everything; other columns
pass through ``keep_clean`` untouched whatever their names.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volpanel.llm.common import release_memory, shuffle_parts, stored

SAMPLE_ROWS = 8_000  # bound of the labelled sample
FOLDS = 5
MAX_FEATURES = 400
MIN_SUPPORT = 3  # labelled toxic rows that hold a feature, at least; one in SUPPORT_PART of them in large samples
SUPPORT_PART = 140
MIN_PRECISION = 0.9  # of the rejected rows, on out-of-fold predictions
MIN_ODDS = 3.0  # log odds of a feature, toxic against the rest
GRAM = 5
CATEGORIES = ("insult", "severe", "toxic")

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def word_features(word: bytes) -> list[bytes]:
    """The word itself (marked by ^ and $) and its character n-grams."""
    s = word.decode("utf-8", "replace")
    return [b"^" + word + b"$", *{s[i : i + GRAM].encode() for i in range(len(s) - GRAM + 1)}]


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


# ---- fitting (one bounded sample) ---------------------------------------------------

def row_features(words) -> set:
    """The distinct features of a row's words."""
    out: set = set()
    for w in words:
        out.update(word_features(w))
    return out


def choose(pos: dict, neg: dict, n1: int, n0: int) -> list[bytes]:
    """Features held by many toxic rows and by few others, by log odds, from the numbers of rows that hold them."""
    pos = {f: n for f, n in pos.items() if n >= max(MIN_SUPPORT, n1 // SUPPORT_PART)}
    odds = {f: np.log((pos[f] + 0.5) / (n1 + 1)) - np.log((neg.get(f, 0) + 0.5) / (n0 + 1)) for f in pos}
    best = sorted((f for f in pos if odds[f] >= MIN_ODDS), key=lambda f: (-pos[f] * odds[f], f))
    return best[:MAX_FEATURES]


def choose_features(words: list[dict], toxic: np.ndarray) -> list[bytes]:
    """``choose`` for rows at hand."""
    held: list[dict[bytes, int]] = [{}, {}]
    for row, y in zip(words, toxic):
        own = held[bool(y)]
        for f in row_features(row):
            own[f] = own.get(f, 0) + 1
    return choose(held[1], held[0], int(toxic.sum()), int(len(toxic) - toxic.sum()))


def counts(rows: list[dict], features: list[bytes]) -> np.ndarray:
    at = {f: i for i, f in enumerate(features)}
    cache: dict[bytes, list[int]] = {}
    out = np.zeros((len(rows), len(features)))
    for r, row in enumerate(rows):
        for w, n in row.items():
            if (ids := cache.get(w)) is None:
                ids = cache[w] = [at[f] for f in word_features(w) if f in at]
            for i in ids:
                out[r, i] += n
    return np.log1p(out)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 15) -> np.ndarray:
    """Newton's method; the last weight is the intercept (not shrunk)."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-3:
            break
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Models of the chain, and the out-of-fold probabilities (rows x categories)."""
    models, earlier = [], np.zeros((len(x), 0))
    for k in range(labels.shape[1]):
        inputs, y = np.hstack([x, earlier]), labels[:, k]
        out = np.full(len(x), y.mean() if len(y) else 0.0)
        for f in range(FOLDS):
            held = fold == f
            if held.any() and not held.all():
                out[held] = predict(inputs[held], fit_logistic(inputs[~held], y[~held]))
        models.append(fit_logistic(inputs, y))
        earlier = np.hstack([earlier, out[:, None]])
    return models, earlier


def chain_scores(x: np.ndarray, models: list[np.ndarray]) -> np.ndarray:
    """Probabilities of a chain, rows x categories."""
    earlier = np.zeros((len(x), 0))
    for w in models:
        earlier = np.hstack([earlier, predict(np.hstack([x, earlier]), w)[:, None]])
    return earlier


def chain_labels(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Categories: insult = a toxic row with a found feature, severe = with three or more words' worth."""
    return np.stack([y * ((x > 0).sum(axis=1) >= 1), y * (np.expm1(x).sum(axis=1) >= 3 * GRAM), y], axis=1)


def held_out_fold(x: np.ndarray, y: np.ndarray, fold: np.ndarray, f: int) -> np.ndarray:
    """Probability of the last category for the rows of fold f, from a chain whose features (the columns of x), labels
    and weights saw the other folds' rows only."""
    held = fold == f
    if held.all():
        return np.full(int(held.sum()), y.mean())
    own = y[~held]
    if own.min() == own.max():
        return np.full(int(held.sum()), own[0])
    models, _ = fit_chain(x[~held], chain_labels(x[~held], own), fold[~held])
    return chain_scores(x[held], models)[:, -1]


def held_out(words: list[dict], y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    out = np.full(len(y), y.mean())
    for f in range(FOLDS):
        held = fold == f
        if held.any():
            features = choose_features([words[i] for i in np.flatnonzero(~held)], y[~held])
            out[held] = held_out_fold(counts(words, features), y, fold, f)
    return out


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1 among those precise enough on out-of-fold predictions, in the middle of its
    gap; 2 (reject nothing) if there is none."""
    order = np.argsort(-p, kind="stable")
    hit, n = np.cumsum(y[order]), np.arange(1, len(p) + 1)
    f1 = 2 * hit / (n + y.sum())
    usable = np.append(p[order][1:] != p[order][:-1], True) & (hit >= MIN_PRECISION * n)  # a cut can't part equal scores
    if not usable.any():
        return 2.0
    i = int(np.argmax(np.where(usable, f1, -1)))
    below = p[order][i + 1] if i + 1 < len(p) else 0.0
    return float((p[order][i] + below) / 2)


def fold_of(ident) -> int:
    """A fold by the id, whatever its type."""
    if ident is None:
        return 0
    return (hash((int(ident), 7)) if isinstance(ident, int) else zlib.crc32(str(ident).encode())) % FOLDS


def empty_model(rows: int) -> dict:
    return {"features": [], "models": [], "threshold": 2.0, "oof_f1": None, "rows": rows}


def as_model(features: list[bytes], models: list, oof: np.ndarray, y: np.ndarray) -> dict:
    cut = best_threshold(oof, y)
    got = oof > cut
    f1 = 2 * float((got * y).sum()) / max(1.0, float(got.sum() + y.sum()))
    return {"features": [f.hex() for f in features], "models": [list(map(float, m)) for m in models], "threshold": cut, "oof_f1": f1, "rows": len(y)}


def word_counts(text: str | None) -> dict[bytes, int]:
    row: dict[bytes, int] = {}
    for w in words_of(text):
        row[w] = row.get(w, 0) + 1
    return row


def fit_rows(ids: list, texts: list, toxic: list) -> dict:
    """The model of a sample at hand; ``fit`` gives the same for rows in the order of their ids."""
    y = np.array([1.0 if t else 0.0 for t in toxic])
    if not len(y) or y.min() == y.max():
        return empty_model(len(y))
    words = [word_counts(text) for text in texts]
    features = choose_features(words, y)
    x = counts(words, features)
    fold = np.array([fold_of(i) for i in ids])
    models, _ = fit_chain(x, chain_labels(x, y), fold)
    return as_model(features, models, held_out(words, y, fold), y)


SAMPLE = "id {kind}, toxic int, fold int, words array<binary>, n array<int>"
FLUSH = 150_000  # features that a counting task holds at once


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """SAMPLE rows: at most ``sample_rows`` labelled documents, one row per doc_id, as counted words."""
    lab = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).where("_id is not null and _toxic is not null")
    lab = lab.groupBy("_id").agg(F.max("_toxic").alias("_toxic")).orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).join(F.broadcast(lab), "_id")
    rows = rows.groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_toxic").alias("_toxic"))

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                made = [word_counts(t) for t in part.column(1).to_pylist()]
                ids = part.column(0).to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "id": part.column(0), "toxic": pa.array([int(bool(t)) for t in part.column(2).to_pylist()], pa.int32()), "fold": pa.array([fold_of(i) for i in ids], pa.int32()),
                    "words": pa.array([list(m) for m in made], pa.list_(pa.binary())), "n": pa.array([list(m.values()) for m in made], pa.list_(pa.int32()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("_id", "_text", "_toxic").mapInArrow(run, SAMPLE.format(kind=kind))


def holders(rows: DataFrame, only: set | None = None) -> DataFrame:
    """feature, fold, n: the numbers of rows that hold a feature (one of ``only``, if given)."""
    def run(batches):
        held: dict[tuple, int] = {}

        def out():
            keys = list(held)
            return pa.RecordBatch.from_pydict({"feature": pa.array([k[0] for k in keys], pa.binary()), "fold": pa.array([k[1] for k in keys], pa.int32()), "n": pa.array(held.values(), pa.int64())})

        for b in batches:
            for words, fold in zip(b.column(0), b.column(1).to_pylist()):
                own = row_features(words.as_py())
                for f in own if only is None else own & only:
                    held[f, fold] = held.get((f, fold), 0) + 1
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        yield out()
        held.clear()
        release_memory()

    return rows.select("words", "fold").mapInArrow(run, "feature binary, fold int, n long").groupBy("feature", "fold").agg(F.sum("n").cast("long").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Fit on at most ``sample_rows`` labelled documents; the sample's ids are broadcast (bounded).

    Collected are counts of features that at least MIN_SUPPORT toxic rows of the sample hold, and one number per row."""
    rows = stored(sample(docs, labels, sample_rows), "toxicity-sample")
    sizes = {(r["toxic"], r["fold"]): r["n"] for r in rows.groupBy("toxic", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = (sum(n for (t, _), n in sizes.items() if t == k) for k in (1, 0))
    if not n1 or not n0:
        return empty_model(n1 + n0)
    rows = rows.repartition(shuffle_parts(rows.sparkSession), "id")
    toxic = stored(holders(rows.where("toxic = 1")), "toxicity-features")
    usual = toxic.groupBy("feature").agg(F.sum("n").alias("_n")).where(F.col("_n") >= MIN_SUPPORT).select("feature")
    pos = {(bytes(r["feature"]), r["fold"]): r["n"] for r in toxic.join(usual, "feature").collect()}
    neg = {(bytes(r["feature"]), r["fold"]): r["n"] for r in holders(rows.where("toxic = 0"), {f for f, _ in pos}).collect()}

    def chosen(without: int | None) -> list[bytes]:
        held: list[dict[bytes, int]] = [{}, {}]
        for own, table in zip(held, (pos, neg)):
            for (f, fold), n in table.items():
                if fold != without:
                    own[f] = own.get(f, 0) + n
        n1, n0 = (sum(n for (t, fold), n in sizes.items() if t == k and fold != without) for k in (1, 0))
        return choose(held[0], held[1], n1, n0)

    folds = sorted({fold for _, fold in sizes})
    # task -1 fits the shipped chain, the others predict their fold
    features = {-1: chosen(None)} | {f: chosen(f) for f in folds}
    ways: dict[bytes, list[tuple[int, int]]] = {}
    for task, own in features.items():
        for i, f in enumerate(own):
            ways.setdefault(f, []).append((task, i))

    def count(batches):
        for b in batches:
            for part in (b.slice(lo, 200) for lo in range(0, b.num_rows, 200)):
                out = {"id": [], "toxic": [], "fold": [], "task": [], "at": [], "n": []}
                for ident, y, fold, words, n in zip(*(part.column(k).to_pylist() for k in range(5))):
                    got: dict[int, dict[int, int]] = {t: {} for t in features}
                    for w, times in zip(words, n):
                        for f in word_features(w):
                            for task, i in ways.get(f, ()):
                                got[task][i] = got[task].get(i, 0) + times
                    for task, own in got.items():
                        for name, v in zip(out, (ident, y, fold, task, list(own), list(own.values()))):
                            out[name].append(v)
                types = dict(zip(out, (b.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()))))
                yield pa.RecordBatch.from_pydict({name: pa.array(v, types[name]) for name, v in out.items()})

    def one(key, t):
        task = key[0].as_py()
        t = t.take(pa.array(np.array(sorted(range(t.num_rows), key=t.column("id").to_pylist().__getitem__), np.int64)))
        y, fold = t.column("toxic").to_numpy().astype(float), t.column("fold").to_numpy()
        x = np.zeros((t.num_rows, len(features[task])))
        for row, at, n in zip(x, t.column("at").to_pylist(), t.column("n").to_pylist()):
            row[at] = n
        x = np.log1p(x)
        release_memory()
        if task < 0:
            models, _ = fit_chain(x, chain_labels(x, y), fold)
            return pa.table({"model": pa.array([json.dumps([m.tolist() for m in models])]), "p": pa.array([None], pa.list_(pa.float64())), "y": pa.array([None], pa.list_(pa.float64()))})
        p = held_out_fold(x, y, fold, task)
        return pa.table({"model": pa.array([None], pa.string()), "p": pa.array([p]), "y": pa.array([y[fold == task]])})

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = rows.select("id", "toxic", "fold", "words", "n").mapInArrow(count, f"id {kind}, toxic int, fold int, task int, at array<int>, n array<long>")
    got = counted.groupBy("task").applyInArrow(one, "model string, p array<double>, y array<double>").collect()
    models = next(json.loads(r["model"]) for r in got if r["model"] is not None)
    oof, y = (np.concatenate([r[k] for r in got if r["model"] is None]) for k in ("p", "y"))
    return as_model(features[-1], models, oof, y)


# ---- scoring (every row) ------------------------------------------------------------

class Scorer:
    """Scores texts with a fitted model; features of a word are looked up once while the cache holds it."""

    MOST_BYTES = 24_000_000

    def __init__(self, model: dict):
        self.at = {bytes.fromhex(f): i for i, f in enumerate(model["features"])}
        self.models = [np.array(m) for m in model["models"]]
        self.cut = model["threshold"]
        self.cache: dict[bytes, tuple] = {}
        self.held = 0

    def scores(self, texts: list) -> np.ndarray:
        """Probabilities, rows x categories."""
        x = np.zeros((len(texts), len(self.at)))
        get, cache, at = self.cache.get, self.cache, self.at
        for r, text in enumerate(texts):
            for w in words_of(text):
                ids = get(w)
                if ids is None:
                    self.held += len(w) + 150  # the key, its entry and the tuple
                    if self.held > self.MOST_BYTES:
                        cache.clear()
                        self.held = 0
                    ids = cache[w] = tuple(at[f] for f in word_features(w) if f in at)
                for i in ids:
                    x[r, i] += 1
        if not self.models:
            return np.zeros((len(texts), len(CATEGORIES)))
        return chain_scores(np.log1p(x), self.models)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, a probability per category, is_toxic: one row per row of ``docs``."""
    def run(batches):
        scorer = Scorer(model)
        for b in batches:
            p = scorer.scores(b.column(1).to_pylist())
            out = {"doc_id": b.column(0)} | {f"p_{c}": p[:, k] for k, c in enumerate(CATEGORIES)}
            yield pa.RecordBatch.from_pydict(out | {"is_toxic": pa.array(p[:, -1] > scorer.cut)})
        del scorer
        release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"p_{c} double" for c in CATEGORIES) + ", is_toxic boolean")


def keep_clean(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that the chain accepts, all columns as they are."""
    at = docs.columns.index("text")
    schema = T.StructType(docs.schema.fields)

    def run(batches):
        scorer = Scorer(model)
        for b in batches:
            p = scorer.scores(b.column(at).to_pylist())
            yield b.filter(pa.array(p[:, -1] <= scorer.cut))
        del scorer
        release_memory()

    return docs.mapInArrow(run, schema)
