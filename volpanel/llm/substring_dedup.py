"""Substring dedup: words covered by a window of ``WINDOW`` words that also starts earlier.

Sharding.  A window belongs to its minimizer, the smallest hash among its ``GRAM``-word grams, so equal
windows have equal minimizers.  Consecutive windows with one minimizer form a segment; a document
is a row of overlapping segments, and a shard holds all segments of its minimizers.  All matches of a
window are therefore in one shard, and every shard is searched only by the documents' parts that can match
there: the work grows with the text, not with text times shards.

1. Each task cuts its documents into segments and reduces equal ones: all but the first in
   (doc_id, start) order are repeats at once.  So a passage that a third of all documents share is
   one row per task, and only hashes travel.  The segments at its edges run into each document's own words and
   stay different: a minimizer with more than ``LOCAL`` of them in one task sends its shard one row that says so, and
   its segments go by their own hash instead.
2. Per shard, equal segments are reduced again.  A minimizer left with one segment has no other match.
   The first occurrences of segments whose minimizer has several ask for their words.
   A minimizer with more than ``CROWDED`` differing segments (near copies of one passage), or with more than
   ``LOCAL`` in one task, has its windows dealt one by one, by the 128-bit hash of their own words, so that they
   spread over all shards.  Equal ones are reduced as segments are: all but the first of a task are repeats at
   once, and a shard gets one row a task.  Equal windows share their minimizer, so all of them are dealt, and no
   words are left to search for.
3. Those words are dealt to the shards.  A shard builds a compressed FM-index (``fmindex``: bounded suffix
   array, wavelet tree over packed rank vectors) of its segments, and streams them through
   backward search; matching statistics of the full ``WINDOW`` length give the suffix-array interval
   of every window, whose earliest position decides which starts repeat.
4. The covered intervals go back to their documents by doc_id.

The index compares words, not hashes; a segment's or dealt window's 128-bit hash stands for it in steps 1 and 2.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: null, empty or short text has no window and keeps all words;
a row without doc_id is not compared and keeps all words; rows that repeat a doc_id with the same text are one
document and share its result; rows that repeat it with other texts are documents of their own, ordered by a hash of the
text; doc_id may be of any type that has an order; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volpanel.llm.common import shuffle_parts, stored, with_order_key
from volpanel.llm.fmindex import FMIndex

KEY = "__order_key"  # the order of doc_id as a long
WINDOW = 20
GRAM = 5
MOST_WINDOWS = 64  # a longer run of one minimizer is cut into segments of so many windows
CHUNK_CHARS = 24_000_000  # text that a task holds at once
SHARDS_PER_PARTITION = 4
CROWDED = 1024  # differing segments of a minimizer beyond which its windows are dealt one by one
LOCAL = 64  # the same within one task's text
HELD_WINDOWS = 400_000  # dealt windows that a task holds at once


def order_key(docs: DataFrame):
    """The order key of rows; without one, their doc_id."""
    return (F.col(KEY) if KEY in docs.columns else F.col("doc_id").cast("long")).alias("doc_id")


# ---- segments --------------------------------------------------------------------------

def word_hashes(words: list[bytes], cache: dict[bytes, int]) -> np.ndarray:
    if len(cache) > 1_000_000:
        cache.clear()
    for w in set(words).difference(cache):
        cache[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def minimizers(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram hashes, the minimizer of every window of ``window`` words)."""
    with np.errstate(over="ignore"):
        g = np.zeros(max(0, len(h) - GRAM + 1), np.uint64)
        for i in range(GRAM):
            g = (g ^ h[i : i + len(g)]) * np.uint64(0x9E3779B97F4A7C15)
            g ^= g >> np.uint64(31)
    grams, left, span = g, window - GRAM + 1, 1
    while span < left:  # minimum over ``left`` grams, by overlapping doubling
        by = min(span, left - span)
        g = np.minimum(g[: len(g) - by], g[by:])
        span += by
    return grams, g


def twice(grams: np.ndarray, mins: np.ndarray, starts: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Segments that hold their minimizer at several places: only those can hold a window twice."""
    if len(np.unique(grams)) == len(grams):
        return np.zeros(len(starts), bool)
    n = sizes + window - GRAM
    ends = np.cumsum(n)
    at = np.repeat(starts - ends + n, n) + np.arange(ends[-1])
    hits = grams[at] == np.repeat(mins[starts], n)
    return np.add.reduceat(hits.astype(np.int64), ends - n) > 1


def segments(mins: np.ndarray, most: int = MOST_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of every segment."""
    cuts = np.flatnonzero(mins[1:] != mins[:-1]) + 1
    starts = np.concatenate([[0], cuts])
    sizes = np.diff(np.append(starts, len(mins)))
    if (sizes > most).any():
        parts = -(-sizes // most)
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, whole = np.repeat(starts, parts) + k * most, np.repeat(sizes, parts)
        sizes = np.minimum(most, whole - k * most)
    return starts, sizes


SEGMENT = "kind int, shard int, mini long, h1 long, h2 long, doc_id long, start int, windows int"
FIRST, REPEAT, ASK, TWICE, DEAL, APART, HOT = 0, 1, 2, 3, 4, 5, 6


def segment_rows(docs: DataFrame, shards: int, window: int, local: int = LOCAL) -> DataFrame:
    """Rows of kind FIRST or TWICE (one per distinct segment of a chunk) and REPEAT (an occurrence after it).

    A minimizer with more than ``local`` segments in a chunk has them as APART, in the shards of their hashes, and one HOT row."""
    def flush(kept: dict, repeats: list):
        n = len(kept) + len(repeats)
        if not n:
            return
        out = np.zeros((7, n), np.int64)
        if kept:
            digests = np.frombuffer(b"".join(kept), np.int64).reshape(-1, 2).T
            own = np.array(list(kept.values()), np.int64).T
            k = len(kept)
            out[0, :k], out[1, :k], out[2:4, :k], out[4:, :k] = own[4], own[0], digests, own[1:4]
        if repeats:
            out[0, len(kept) :] = REPEAT
            out[4:, len(kept) :] = np.array(repeats, np.int64).T
        if kept:
            minis, code, count = np.unique(out[1, :k], return_inverse=True, return_counts=True)
            out[0, :k][count[code] > local] = APART
            hot = np.zeros((7, int((count > local).sum())), np.int64)
            hot[0], hot[1] = HOT, minis[count > local]
            out = np.concatenate([out, hot], axis=1)
            n = out.shape[1]
        home = np.where(out[0] == REPEAT, out[4], np.where(out[0] == APART, out[2], out[1])) % shards
        cols = [pa.array(out[0].astype(np.int32)), pa.array(home.astype(np.int32)), *[pa.array(out[k]) for k in (1, 2, 3, 4)], pa.array(out[5].astype(np.int32)), pa.array(out[6].astype(np.int32))]
        names = [c.split()[0] for c in SEGMENT.split(", ")]
        for lo in range(0, n, 50_000):
            yield pa.RecordBatch.from_arrays([c.slice(lo, 50_000) for c in cols], names=names)

    def run(batches):
        cache: dict[bytes, int] = {}
        kept: dict[bytes, tuple] = {}
        repeats: list[tuple] = []
        held = 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = (text or "").encode().split()
                if doc is None or len(words) < window:
                    continue
                grams, mins = minimizers(word_hashes(words, cache), window)
                starts, sizes = segments(mins)
                kinds = np.where(twice(grams, mins, starts, sizes, window), TWICE, FIRST)
                for at, n, mini, kind in zip(starts.tolist(), sizes.tolist(), mins[starts].view(np.int64).tolist(), kinds.tolist()):
                    digest = xxhash.xxh3_128_digest(b" ".join(words[at : at + n + window - 1]))
                    old = kept.get(digest)
                    if old is None:
                        kept[digest] = (mini, doc, at, n, kind)
                    elif (doc, at) > (old[1], old[2]):
                        repeats.append((doc, at, n))
                    elif (doc, at) < (old[1], old[2]):
                        repeats.append(old[1:4])
                        kept[digest] = (mini, doc, at, n, kind)
                held += len(text)
                if held >= CHUNK_CHARS:
                    yield from flush(kept, repeats)
                    kept, repeats, held = {}, [], 0
        yield from flush(kept, repeats)

    return docs.select(order_key(docs), "text").mapInArrow(run, SEGMENT)


RESOLVED = "kind int, mini long, doc_id long, start int, windows int"


def resolver(crowded: int):
    def run(t: pa.Table) -> pa.Table:
        return resolve(t, crowded)

    return run


def resolve(t: pa.Table, crowded: int = CROWDED) -> pa.Table:
    """One shard: repeats of equal segments, and requests for the words of segments that share a minimizer."""
    kind, mini, h1, h2, doc, start, n = (t.column(c).to_numpy() for c in ("kind", "mini", "h1", "h2", "doc_id", "start", "windows"))
    done = np.flatnonzero(kind == REPEAT)
    own = np.flatnonzero((kind != REPEAT) & (kind != HOT))
    own = own[np.lexsort((start[own], doc[own], h2[own], h1[own]))]
    out_kind = [np.full(len(done), REPEAT, np.int32)]
    out = [done]
    if len(own):
        same = (h1[own][1:] == h1[own][:-1]) & (h2[own][1:] == h2[own][:-1])
        lead = np.concatenate([[True], ~same])
        first = own[np.flatnonzero(lead)[np.cumsum(lead) - 1]]  # of every occurrence's segment
        later = own[(doc[own] > doc[first]) | (start[own] > start[first])]
        firsts = own[lead]
        _, code, count = np.unique(mini[firsts], return_inverse=True, return_counts=True)
        # several segments, or one that can hold a window twice
        deal = (count[code] > crowded) | (kind[firsts] == APART) | np.isin(mini[firsts], mini[kind == HOT])
        several = deal | (count[code] > 1) | (kind[firsts] == TWICE)
        out += [later, firsts[several]]
        out_kind += [np.full(len(later), REPEAT, np.int32), np.where(deal[several], DEAL, ASK).astype(np.int32)]
    rows = np.concatenate(out)
    return pa.table({"kind": np.concatenate(out_kind), "mini": mini[rows], "doc_id": doc[rows], "start": start[rows], "windows": n[rows]})


# ---- FM-index of a shard -----------------------------------------------------------------

def repeated_windows(docs: np.ndarray, starts: np.ndarray, texts: list[list[bytes]], window: int) -> list[tuple[int, int, int]]:
    """(doc, first window, windows) of the windows that also start earlier, among segments given by their words."""
    ids: dict[bytes, int] = {}
    coded = [np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words)) for words in texts]
    end = len(ids)
    seq = np.concatenate([np.append(c, end) for c in coded])
    index = FMIndex(seq, window)
    lengths = np.array([len(c) for c in coded])
    rows = np.full((len(coded), int(lengths.max())), -1, np.int64)
    for r, c in enumerate(coded):
        rows[r, : len(c)] = c
    found, lo, _ = index.statistics(rows, lengths)
    r, at = np.nonzero(found == window)
    where = lo[r, at]  # windows of one interval are equal
    doc, pos = docs[r], starts[r] + at
    order = np.lexsort((pos, doc, where))
    w, d, p = where[order], doc[order], pos[order]
    lead = np.concatenate([[True], w[1:] != w[:-1]])
    first = np.flatnonzero(lead)[np.cumsum(lead) - 1]
    later = (d > d[first]) | (p > p[first])
    d, p = d[later], p[later]
    order = np.lexsort((p, d))
    d, p = d[order], p[order]
    if not len(d):
        return []
    cut = np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1)])
    heads = np.flatnonzero(cut)
    tails = np.append(heads[1:], len(d)) - 1
    return list(zip(d[heads].tolist(), p[heads].tolist(), (p[tails] - p[heads] + 1).tolist()))


def repeated_hashes(docs: np.ndarray, starts: np.ndarray, digests: list[bytes]) -> np.ndarray:
    """Rows whose hash also has an earlier (doc, start)."""
    h1, h2 = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2).T
    order = np.lexsort((starts, docs, h2, h1))
    lead = np.concatenate([[True], (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])])
    first = order[np.flatnonzero(lead)[np.cumsum(lead) - 1]]
    return order[(docs[order] > docs[first]) | (starts[order] > starts[first])]


def search_shard(window: int):
    def run(t: pa.Table) -> pa.Table:
        kind, docs, starts, windows = (t.column(c).to_numpy() for c in ("kind", "doc_id", "start", "windows"))
        starts, words = starts.astype(np.int64), t.column("words")
        out = [(docs[own], starts[own], windows[own]) for own in [np.flatnonzero(kind == REPEAT)]]
        if len(own := np.flatnonzero(kind == DEAL)):
            own = own[repeated_hashes(docs[own], starts[own], words.take(pa.array(own)).to_pylist())]
            out.append((docs[own], starts[own], windows[own]))
        if len(own := np.flatnonzero(kind == ASK)):
            got = repeated_windows(docs[own], starts[own], [x.split(b" ") for x in words.take(pa.array(own)).to_pylist()], window)
            out += [tuple(np.array(x, np.int64) for x in zip(*got))] if got else []
        d, s, n = (np.concatenate(x) for x in zip(*out))
        return pa.table({"doc_id": d.astype(np.int64), "start": s.astype(np.int32), "windows": n.astype(np.int32)})

    return run


ASKED = "kind int, shard int, doc_id long, start int, windows int, words binary"


def asked_words(docs: DataFrame, asked: DataFrame, shards: int, window: int) -> DataFrame:
    """ASK: a requested segment's words; DEAL: hash of the first of equal dealt windows of a task; REPEAT: those after it."""
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in ASKED.split(", ")]

    def batches_of(rows: list):
        for lo in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[lo : lo + 20_000]), kinds)], names=names)

    def first_rows(firsts: dict):
        return batches_of([(DEAL, int.from_bytes(h[:8], "little") % shards, doc, at, 1, h) for h, (doc, at) in firsts.items()])

    def run(batches):
        firsts: dict[bytes, tuple] = {}
        for b in batches:
            out = []
            for doc, text, segs in zip(*(b.column(k).to_pylist() for k in range(3))):
                words = (text or "").encode().split()
                for s in segs:
                    at, n = s["start"], s["windows"]
                    if not s["deal"]:
                        out.append((ASK, s["shard"], doc, at, n, b" ".join(words[at : at + n + window - 1])))
                        continue
                    begin = None  # of a run of repeats
                    for i in range(at, at + n):
                        digest = xxhash.xxh3_128_digest(b" ".join(words[i : i + window]))
                        old = firsts.setdefault(digest, (doc, i))
                        if old < (doc, i):
                            begin = i if begin is None else begin
                            continue
                        if begin is not None:
                            out.append((REPEAT, doc % shards, doc, begin, i - begin, None))
                            begin = None
                        if old > (doc, i):
                            out.append((REPEAT, old[0] % shards, *old, 1, None))
                            firsts[digest] = (doc, i)
                    if begin is not None:
                        out.append((REPEAT, doc % shards, doc, begin, at + n - begin, None))
                if len(firsts) >= HELD_WINDOWS:
                    yield from first_rows(firsts)
                    firsts = {}
            yield from batches_of(out)
        yield from first_rows(firsts)

    home = F.pmod(F.xxhash64("mini"), F.lit(shards)).cast("int")
    per_doc = asked.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set(F.struct(home.alias("shard"), "start", "windows", (F.col("kind") == DEAL).alias("deal"))).alias("segs"))
    rows = docs.select(order_key(docs), "text").join(per_doc, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "segs")
    return rows.mapInArrow(run, ASKED)


def repeats(docs: DataFrame, window: int = WINDOW, crowded: int = CROWDED, local: int = LOCAL) -> DataFrame:
    """(doc_id, start, windows): runs of windows whose words also start earlier; ``docs`` and the result by order key."""
    shards = SHARDS_PER_PARTITION * shuffle_parts(docs.sparkSession)
    rows = segment_rows(docs, shards, window, local)
    resolved = stored(rows.groupBy("shard").applyInArrow(resolver(crowded), RESOLVED), "segments")
    words = asked_words(docs, resolved.where(F.col("kind") != REPEAT), shards, window)
    searched = words.groupBy("shard").applyInArrow(search_shard(window), "doc_id long, start int, windows int")
    return resolved.where(F.col("kind") == REPEAT).select("doc_id", "start", "windows").unionByName(searched)


def covered(n: int, starts: list[int], windows: list[int], window: int) -> np.ndarray:
    """Mask of the words that those runs cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.array(starts, np.int64), 1)
    np.add.at(edge, np.minimum(np.array(starts, np.int64) + np.array(windows, np.int64) + window - 1, n), -1)
    return np.cumsum(edge[:-1]) > 0


def report(docs: DataFrame, window: int = WINDOW, crowded: int = CROWDED, local: int = LOCAL) -> DataFrame:
    """doc_id, kept_text, n_words, n_removed, kept_sha256."""
    docs = with_order_key(docs.select("doc_id", "text"), KEY, own_text=True)
    runs = repeats(docs, window, crowded, local).groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("start").alias("starts"), F.collect_list("windows").alias("windows"))

    def run(batches):
        for b in batches:
            kept, n_words, n_removed, sha = [], [], [], []
            for text, starts, windows in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                words = (text or "").encode().split()
                n, gone = len(words), 0
                if starts:
                    mask = covered(n, starts, windows, window)
                    gone = int(mask.sum())
                    words = [w for w, x in zip(words, mask.tolist()) if not x]
                joined = b" ".join(words)
                kept.append(joined.decode())
                n_words.append(n)
                n_removed.append(gone)
                sha.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "kept_text": pa.array(kept, pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})

    rows = docs.join(runs, F.col(KEY) == F.col("_id"), "left").select("doc_id", "text", "starts", "windows")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, kept_text string, n_words long, n_removed long, kept_sha256 string")
