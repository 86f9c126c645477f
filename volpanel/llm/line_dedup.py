"""Line dedup with sharded minimal perfect hashes.

1. Every row's distinct long line keys become 128-bit hashes (two longs), counted over distinct
   doc_id by Spark's two-step distinct aggregate, which spreads a hot line over all tasks.
2. The distinct hashes held by at least ``min_docs`` documents are dealt to shards of bounded size.
   Each shard is a minimal perfect hash (``mphf``) over the first long, and arrays at the slot
   numbers: the second long as fingerprint, the document count and the largest doc_id.
3. Documents probe those arrays, written once to the shared folder: a task reads the shards one at
   a time for a batch of rows, so a line never joins a line, no text is shuffled, and a hot line is
   only one slot.  A foreign hash passes a slot with probability 2**-64.

Memory of a probing task: one Arrow batch and one shard (``SHARD_KEYS`` keys of about 22 bytes).

A key is the line stripped of space and U+0009..U+000D, A-Z lower-cased.  Keys of at least
``min_chars`` code points lose all their lines but those in the largest doc_id that holds them.

Defined cases: null or empty text is one empty line; repeated rows of one doc_id count as one
document and are all treated alike; a row without doc_id is counted for no line and keeps all its
lines; doc_id may be of any type that has an order; an empty table gives an empty result.  Other columns pass through untouched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volpanel.llm import mphf
from volpanel.llm.common import release_memory, shared_path, stored, with_order_key, worker_rows

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 262_144
KEY = "__order_key"  # the order of doc_id as a long
STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(STRIP).lower()


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


def hashed(key: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(key)
    return d & 0xFFFFFFFFFFFFFFFF, d >> 64


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id): the distinct long keys of each row, with its order key."""
    def run(batches):
        for b in batches:
            h, who = [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if doc is None or not text or len(text) < min_chars:
                    continue
                own = {k for k in map(line_key, text.encode().split(b"\n")) if len(k) >= min_chars and code_points(k) >= min_chars}
                h += map(hashed, own)
                who += [doc] * len(own)
            if who:
                a = np.array(h, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_pydict({"h1": a[:, 0].copy(), "h2": a[:, 1].copy(), "doc_id": pa.array(who, pa.int64())})
        release_memory()

    return docs.select(KEY, "text").mapInArrow(run, "h1 long, h2 long, doc_id long")


def build_index(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> tuple[str, int]:
    """(folder with one row per shard, number of shards); no folder if no line repeats enough."""
    spark = docs.sparkSession
    counted = line_hashes(docs, min_chars).groupBy("h1", "h2").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("last"))
    kept = stored(counted.where(F.col("n") >= min_docs), "line-counts")
    keys = kept.count()
    if not keys:
        return "", 0
    shards = -(-keys // SHARD_KEYS)

    def pack(t: pa.Table) -> pa.Table:
        h1, h2, n, last = (t.column(c).to_numpy() for c in ("h1", "h2", "n", "last"))
        h1 = h1.view(np.uint64)
        _, first = np.unique(h1, return_index=True)  # equal first longs: the others go to the extra list
        extra = np.setdiff1d(np.arange(len(h1)), first)
        parts = mphf.build(h1[first])
        slot = mphf.Lookup(parts)(h1[first])
        at = np.empty(len(first), np.int64)
        at[slot] = first
        row = {k: [v.tobytes()] for k, v in parts.items()}
        row |= {"prints": [h2[at].tobytes()], "counts": [n[at].astype(np.int32).tobytes()], "lasts": [last[at].tobytes()]}
        row |= {"extra": [np.stack([h1[extra].view(np.int64), h2[extra], last[extra]]).tobytes()]}
        return pa.table({"shard": pa.array([t.column("shard")[0].as_py()], pa.int32())} | {k: pa.array(v, pa.binary()) for k, v in row.items()})

    path = shared_path(spark, "line-index")
    columns = ("bits", "sizes", "rest", "prints", "counts", "lasts", "extra")
    sharded = kept.withColumn("shard", F.pmod(F.col("h2"), F.lit(shards)).cast("int"))
    index = sharded.groupBy("shard").applyInArrow(pack, "shard int, " + ", ".join(f"{c} binary" for c in columns))
    index.withColumn("part", F.col("shard")).write.partitionBy("part").parquet(path)
    return path, shards


class Shard:
    """One shard's arrays, read from the shared folder."""

    def __init__(self, path: str, k: int):
        row = worker_rows(f"{path}/part={k}").to_pylist()
        self.empty = not row
        if row:
            r = row[0]
            self.find = mphf.Lookup({"bits": np.frombuffer(r["bits"], np.uint64), "sizes": np.frombuffer(r["sizes"], np.int64), "rest": np.frombuffer(r["rest"], np.uint64)})
            self.prints, self.lasts = np.frombuffer(r["prints"], np.int64), np.frombuffer(r["lasts"], np.int64)
            self.extra = np.frombuffer(r["extra"], np.int64).reshape(3, -1)

    def lasts_of(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, largest doc_id) of each hash."""
        slot = self.find(h1)
        at = np.maximum(slot, 0)
        known = (slot >= 0) & (self.prints[at] == h2)
        last = self.lasts[at].copy()
        for a, b, doc in self.extra.T:
            same = (h1.view(np.int64) == a) & (h2 == b)
            known |= same
            last[same] = doc
        return known, last


class Prober:
    """Drops lines of a batch of texts against the index."""

    def __init__(self, path: str, shards: int, min_chars: int):
        self.path, self.shards, self.min_chars = path, shards, min_chars
        self.held: tuple[int, Shard] | None = None
        self.gone: set[int] = set()

    def shard(self, k: int) -> Shard | None:
        if k in self.gone:
            return None
        if self.held is None or self.held[0] != k:
            try:
                self.held = (k, Shard(self.path, k))
            except FileNotFoundError:  # a shard that got no key has no folder
                self.gone.add(k)
                return None
        return self.held[1]

    def __call__(self, ids: list, texts: list) -> list[tuple[bytes, int, int]]:
        """(kept text, lines before, lines dropped) of each row."""
        lines = [(t or "").encode().split(b"\n") for t in texts]
        keep = [None] * len(lines)
        row, pos, h = [], [], []
        if self.shards:
            for r, (doc, own) in enumerate(zip(ids, lines)):
                if doc is None:
                    continue
                for i, line in enumerate(own):
                    if len(line) >= self.min_chars:
                        k = line_key(line)
                        if len(k) >= self.min_chars and code_points(k) >= self.min_chars:
                            row.append(r)
                            pos.append(i)
                            h.append(hashed(k))
        if h:
            a = np.array(h, np.uint64)
            h1, h2, row, pos = a[:, 0].copy(), a[:, 1].copy().view(np.int64), np.array(row), np.array(pos)
            own = np.array([i if i is not None else 0 for i in ids], np.int64)[row]
            home = h2 % self.shards  # as pmod: numpy's remainder has the divisor's sign
            order = np.argsort(home, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                if (s := self.shard(int(home[part[0]]))) is None:
                    continue
                known, last = s.lasts_of(h1[part], h2[part])
                for i in part[known & (last != own[part])]:
                    if keep[row[i]] is None:
                        keep[row[i]] = set()
                    keep[row[i]].add(int(pos[i]))
        out = []
        for own, drop in zip(lines, keep):
            left = own if drop is None else [x for i, x in enumerate(own) if i not in drop]
            out.append((b"\n".join(left), len(own), 0 if drop is None else len(drop)))
        return out


def dedup_report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, kept_text, n_lines, n_dropped, kept_sha256."""
    docs = with_order_key(docs.select("doc_id", "text"), KEY)
    path, shards = build_index(docs, min_docs, min_chars)

    def run(batches):
        probe = Prober(path, shards, min_chars)
        for b in batches:
            got = probe(b.column(2).to_pylist(), b.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "kept_text": pa.array([g[0].decode() for g in got], pa.string()),
                "n_lines": pa.array([g[1] for g in got], pa.int64()), "n_dropped": pa.array([g[2] for g in got], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string()),
            })
            del got
        del probe
        release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, kept_text string, n_lines long, n_dropped long, kept_sha256 string")


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text`` (and ``n_chars`` counted anew if present)."""
    fields = docs.schema.fields
    docs = with_order_key(docs, KEY)
    path, shards = build_index(docs, min_docs, min_chars)
    names = docs.columns
    i_doc, i_text = names.index(KEY), names.index("text")
    i_n = names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        probe = Prober(path, shards, min_chars)
        for b in batches:
            texts = b.column(i_text).to_pylist()
            got = [g[0].decode() if g[2] else t for g, t in zip(probe(b.column(i_doc).to_pylist(), texts), texts)]
            columns = list(b.columns)
            columns[i_text] = pa.array(got, b.schema.field(i_text).type)
            if i_n is not None:
                columns[i_n] = pa.array([old if a is None or a is t else len(a) for a, t, old in zip(got, texts, b.column(i_n).to_pylist())], b.schema.field(i_n).type)
            yield pa.RecordBatch.from_arrays(columns[:i_doc], schema=pa.schema(list(b.schema)[:i_doc]))
        del probe
        release_memory()

    return docs.mapInArrow(run, T.StructType(fields))
