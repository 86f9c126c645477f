"""Benchmark decontamination: size-partitioned MinHash containment search.

A document contains an item if at least ``THRESHOLD`` of the item's distinct ``WORDS``-word shingles
are among the document's.  Items are short and documents long, so a fixed-length signature of the
document would drown the item; here the items carry the sketch and the documents' shingles search it:

1. Items are partitioned by size (number of distinct shingles, powers of two).  In a partition whose
   largest item has u shingles, at most u - ceil(THRESHOLD * u) of an item's shingles may be missing
   from a document.  An item's sketch is its bottom-k MinHash with k = that number + ``EXTRA``: its k
   smallest shingle hashes.  A document that contains the item holds at least k - missing of them,
   so no containment is lost (the sketch of a small item is all of its shingles).
2. Sketches are written to the shared folder in blocks of at most ``BLOCK_ITEMS`` items; a task reads
   one block at a time and looks the shingle hashes of a batch of documents up in it.  Documents are
   read once, never shuffled, and nothing is broadcast, whatever the size of the benchmark.
3. (document, item) pairs with enough sketch hits are verified at once by exact containment on the
   shingles themselves (words, not hashes).

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; an item of fewer than ``WORDS`` words has one
shingle, its whole sequence, and is searched with windows of that length.

Defined cases: null, empty or blank text (item or document) has no shingle, contains nothing and is
contained nowhere; repeated items are reported item by item, rows that repeat an item_id or doc_id
row by row; rows without id are reported with a null id; an empty benchmark finds nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volpanel.llm.common import release_memory, shared_path, worker_rows

WORDS = 5
THRESHOLD = 0.8
EXTRA = 4
BLOCK_ITEMS = 20_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def needed(n: int) -> int:
    """Shingles of n that must be found."""
    return math.ceil(THRESHOLD * n - 1e-9)


class WordHashes:
    """64-bit hashes of words, looked up once per task."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        if len(self.cache) > 1_000_000:
            self.cache.clear()
        cache = self.cache
        for w in set(words).difference(cache):
            cache[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive words."""
    with np.errstate(over="ignore"):
        out = np.zeros(max(0, len(h) - n + 1), np.uint64)
        for i in range(n):
            out = (out ^ h[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def shingles(words: list[bytes], n: int) -> list[tuple]:
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


def sketch_rows(ids: list, texts: list) -> dict:
    """Per item: its length of shingle, sketch hashes and needed hits."""
    of, out = WordHashes(), {"item_id": [], "text": [], "n": [], "sketch": [], "hits": []}
    for item, text in zip(ids, texts):
        words = words_of(text)
        if not words:
            continue
        n = min(WORDS, len(words))
        h = np.unique(rolled(of(words), n))
        size = len(h)
        top = 1 << (size - 1).bit_length()  # largest size of the item's partition
        missing = top - needed(top)
        k = min(size, missing + EXTRA)
        # of the item's own shingles at most size - needed(size) <= missing are absent
        out["item_id"].append(item)
        out["text"].append(text)
        out["n"].append(n)
        out["sketch"].append(h[:k].tobytes())
        out["hits"].append(max(1, k - (size - needed(size))))
    return out


def build_sketches(benchmark: DataFrame) -> tuple[str, int]:
    """(folder of sketch blocks, number of blocks)."""
    spark = benchmark.sparkSession
    total = benchmark.count()
    blocks = -(-total // BLOCK_ITEMS)
    if not blocks:
        return "", 0
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = sketch_rows(b.column(0).to_pylist(), b.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"item_id": pa.array(rows["item_id"], b.schema.field(0).type), "text": pa.array(rows["text"], pa.string()), "n": pa.array(rows["n"], pa.int32()), "sketch": pa.array(rows["sketch"], pa.binary()), "hits": pa.array(rows["hits"], pa.int32())})

    path = shared_path(spark, "sketches")
    rows = benchmark.select("item_id", "text").mapInArrow(run, f"item_id {kind}, text string, n int, sketch binary, hits int")
    block = F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int")
    # each block becomes its own folder; a block of equal texts is salted by the id
    rows.withColumn("block", F.pmod(block + F.pmod(F.xxhash64("item_id"), F.lit(blocks)), F.lit(blocks)).cast("int")).write.partitionBy("block").parquet(path)
    return path, blocks


class Block:
    """Sketches of one block: sorted hashes with the items that hold them, by shingle length."""

    def __init__(self, path: str, k: int):
        try:
            t = worker_rows(f"{path}/block={k}").to_pydict()
        except FileNotFoundError:
            t = {"item_id": [], "text": [], "n": [], "sketch": [], "hits": []}
        self.ids, self.hits = t["item_id"], np.array(t["hits"], np.int64)
        self.sets = [set(shingles(words_of(x), n)) for x, n in zip(t["text"], t["n"])]
        self.lengths = t["n"]
        self.tables = {}
        for n in sorted(set(t["n"])):
            mine = [i for i, x in enumerate(t["n"]) if x == n]
            h = np.concatenate([np.frombuffer(t["sketch"][i], np.uint64) for i in mine])
            who = np.concatenate([np.full(len(t["sketch"][i]) // 8, i) for i in mine])
            order = np.argsort(h, kind="stable")
            # a 16-bit prefilter in front of the binary search
            seen = np.zeros(1 << 20, bool)
            seen[(h >> np.uint64(44)).astype(np.int64)] = True
            self.tables[n] = (h[order], who[order], seen)


class Search:
    def __init__(self, path: str, blocks: int):
        self.path, self.blocks, self.of = path, blocks, WordHashes()
        self.held: tuple[int, Block] | None = None

    def block(self, k: int) -> Block:
        if self.held is None or self.held[0] != k:
            self.held = (k, Block(self.path, k))
        return self.held[1]

    def __call__(self, texts: list) -> list[tuple]:
        """(row, item_id, item shingles, shingles found), verified."""
        found, hashes = [], []
        for text in texts:
            hashes.append(self.of(words_of(text)))
        for k in range(self.blocks):
            b = self.block(k)
            for r, h in enumerate(hashes):
                hits: dict[int, int] = {}
                for n, (keys, who, seen) in b.tables.items():
                    g = rolled(h, n)
                    g = np.unique(g[seen[(g >> np.uint64(44)).astype(np.int64)]])
                    if not len(g):
                        continue
                    lo, hi = np.searchsorted(keys, g, "left"), np.searchsorted(keys, g, "right")
                    for a, z in zip(lo[hi > lo], hi[hi > lo]):
                        for i in who[a:z].tolist():
                            hits[i] = hits.get(i, 0) + 1
                own: dict[int, set] = {}
                for i, n_hits in hits.items():
                    if n_hits < b.hits[i]:
                        continue
                    n = b.lengths[i]
                    if n not in own:
                        own[n] = set(shingles(words_of(texts[r]), n))
                    both = len(b.sets[i] & own[n])
                    if both >= needed(len(b.sets[i])):
                        found.append((r, b.ids[i], len(b.sets[i]), both))
        return found


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_found, containment: every pair at or above the threshold."""
    path, blocks = build_sketches(benchmark)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches):
        search = Search(path, blocks)
        for b in batches:
            got = search(b.column(1).to_pylist())
            ids = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[g[0]] for g in got], b.schema.field(0).type), pa.array([g[1] for g in got], pa.from_numpy_dtype(np.int64) if item_type == "bigint" else None),
                 pa.array([g[2] for g in got], pa.int64()), pa.array([g[3] for g in got], pa.int64()), pa.array([g[3] / g[2] for g in got], pa.float64())],
                names=["doc_id", "item_id", "n_item", "n_found", "containment"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, item_id {item_type}, n_item long, n_found long, containment double")


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, all columns as they are."""
    path, blocks = build_sketches(benchmark)
    at = docs.columns.index("text")

    def run(batches):
        search = Search(path, blocks)
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[[g[0] for g in search(b.column(at).to_pylist())]] = False
            yield b.filter(pa.array(keep))
        del search
        release_memory()

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
