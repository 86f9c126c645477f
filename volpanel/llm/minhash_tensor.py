"""MinHash near-dedup with tensored banding.

Plain banding of L table keys with K minhashes each needs K * L minhashes.  Here two small collections
of ``SIDE`` sub-keys with ``ROWS`` minhashes each are made, and every pair (one sub-key of each collection)
is a table key: SIDE ** 2 keys of 2 * ROWS minhashes from 2 * SIDE * ROWS minhashes (96 in place of 1536).
Two sets of likeness s miss each other with probability 1 - (1 - (1 - s ** ROWS) ** SIDE) ** 2, that is
2e-5 at s = 0.8.

1. Each whole text becomes its set of distinct word-pair hashes (64 bits), from that the sub-keys and a
   128-bit sum that names the set.  Equal sets are one class, one row from here on.
2. Sub-keys that no other class holds are dropped, because a table key needs both its sub-keys; the pairs
   of the rest are the table keys.  Tables are read as sorted runs: a task holds a row, not a table entry.
3. Candidates are verified on whole sets, by exact integer arithmetic.  The members of all table entries with one first member
   are a group; every candidate pair stands in at least one.  A group's members meet in cells of at most ``CELL`` x ``CELL``, as
   whole sets: a cell links what it can by a few stars, counts the common shingles of all pairs that are not yet
   connected by matrix products, and hands out a spanning forest.  No pairs are made as rows.
4. Components come from the star steps of ``simhash.components``.

Defined cases: null, empty or blank text has no shingle and is linked with nothing (its component is its
doc_id); one word is one shingle; repeated rows get equal results; rows that repeat a doc_id with other texts are
classes of their own; a row without doc_id takes no part, has no component and is kept.  doc_id may be of
any type that has an order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volpanel.llm.common import shuffle_parts, stored
from volpanel.llm.simhash import components

SHINGLE = 2
SIDE = 16  # sub-keys of a collection
ROWS = 3  # minhashes of a sub-key
LIKENESS = 80  # per cent
CELL = 1024
STARS = 12  # of a larger cell, before all pairs are counted
BUCKET = 2_000_000
COLUMNS = 2048  # shingles of a matrix product
MOST_WORDS = 300_000  # word hashes that a task holds
STEP = 2048  # shingles hashed at once

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M3
    return (x ^ (x >> np.uint64(29))) * _M2


class Shingler:
    """Distinct hashes of the word pairs of texts."""

    def __init__(self, n: int = SHINGLE):
        self.n, self.known = n, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []  # bytes: A-Z only, U+0020 and U+0009..U+000D only
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(words))
        got = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            got = mix(got * _M1 + h[k : len(words) - n + 1 + k])
        return np.unique(got)


def sub_keys(hashes: np.ndarray, side: int = SIDE, rows: int = ROWS) -> np.ndarray:
    """The 2 * side sub-keys of a set; a value is bound to its place, its lowest bit tells the collection."""
    a = np.random.default_rng(20).integers(0, 1 << 31, (2 * side * rows, 1), np.uint32) * np.uint32(2) + np.uint32(1)
    least, x = np.full(2 * side * rows, np.uint32(0xFFFFFFFF)), (hashes >> np.uint64(32)).astype(np.uint32)
    room = np.empty((len(a), min(STEP, len(x))), np.uint32)
    for lo in range(0, len(x), STEP):
        part = x[lo : lo + STEP]
        np.minimum(least, np.multiply(a, part, out=room[:, : len(part)]).min(axis=1), out=least)
    least = least.astype(np.uint64)
    out = np.arange(1, 2 * side + 1, dtype=np.uint64)
    for k in range(rows):
        out = mix(out * _M1 + least[k::rows])
    return (out >> np.uint64(1) << np.uint64(1)) + np.repeat(np.array([0, 1], np.uint64), side)


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n, s1, s2, subs: size, 128-bit sum and sub-keys of every row's set."""
    def run(batches):
        make = Shingler(shingle)
        for b in batches:
            n, s1, s2, subs = [], [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                h = make(text)
                n.append(len(h))
                s1.append(mix(h ^ _M1).sum(dtype=np.uint64))
                s2.append(mix(h ^ _M2).sum(dtype=np.uint64))
                subs.append(sub_keys(h).view(np.int64) if len(h) else np.zeros(0, np.int64))
            sums = [pa.array(np.array(s, np.uint64).view(np.int64)) for s in (s1, s2)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *sums, pa.array(subs, pa.list_(pa.int64()))], ["doc_id", "n", "s1", "s2", "subs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, s1 long, s2 long, subs array<long>")


def shared(rows: DataFrame) -> DataFrame:
    """key, id, place, first of the rows (key, id) whose key stands in two rows at least.

    ``place`` numbers the rows of a key, ``first`` is the id at place 0.  A task streams its sorted rows and holds
    one batch and one open row."""
    def run(batches):
        def out(key, ident, place, first):
            return pa.RecordBatch.from_pydict({"key": key, "id": ident, "place": place, "first": first})

        open_key, open_first, open_place = None, 0, 0  # the last row: its key's first id, its own place
        for b in batches:
            key, ident = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(key):
                continue
            new = np.append(True, key[1:] != key[:-1])
            goes_on = open_key is not None and open_key == key[0]
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            place, first = np.arange(len(key)) - start, ident[start]
            if goes_on:
                run_ = start == 0
                place = np.where(run_, place + open_place + 1, place)
                first = np.where(run_, open_first, first)
            keep = (place > 0) | np.append(~new[1:], False)
            if goes_on and open_place == 0:  # the open row was the first of its key and is known to be shared now
                yield out(key[:1], np.array([open_first]), np.array([0]), np.array([open_first]))
            yield out(key[keep], ident[keep], place[keep], first[keep])
            # a row at place 0 at the end of a batch stays open: it is handed out when its key comes again
            open_key, open_first, open_place = key[-1], first[-1], place[-1]

    parts = shuffle_parts(rows.sparkSession)
    return rows.select("key", "id").repartition(parts, "key").sortWithinPartitions("key", "id").mapInArrow(run, "key long, id long, place long, first long")


def table_entries(classes: DataFrame) -> DataFrame:
    """key, id, place, first of the table entries with two classes at least."""
    subs = classes.where("n > 0").select("id", F.explode("subs").alias("key"))
    own = shared(subs).groupBy("id").agg(F.collect_list("key").alias("s"))
    one = F.filter("s", lambda x: x.bitwiseAND(F.lit(1)) == 0)
    two = F.filter("s", lambda x: x.bitwiseAND(F.lit(1)) == 1)
    keys = own.select("id", one.alias("u"), two.alias("v")).select("id", F.explode("u").alias("x"), "v").select("id", "x", F.explode("v").alias("y"))
    return shared(keys.select("id", F.xxhash64("x", "y").alias("key")))


def whole_sets(docs: DataFrame, classes: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """id, n, h: the sets of ``classes`` (id, n, s1, s2, doc), made again from their first document's text."""
    def run(batches):
        make = Shingler(shingle)
        for b in batches:
            sets = [make(t) for t in b.column(0).cast(pa.binary()).to_pylist()]
            good = pa.array([len(h) == n and mix(h ^ _M1).sum(dtype=np.uint64).view(np.int64) == s for h, n, s in zip(sets, b.column(2).to_pylist(), b.column(3).to_pylist())], pa.bool_())
            # rows that repeat the doc_id with another text are not this class
            yield pa.RecordBatch.from_pydict({"id": b.column(1), "n": b.column(2), "h": pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))}).filter(good)

    named = classes.select("id", "n", "s1", F.col("doc").alias("_doc"))
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).join(named, F.col("_id") == F.col("_doc"))
    return rows.select("_text", "id", "n", "s1").mapInArrow(run, "id long, n long, h array<long>").dropDuplicates(["id"])


class Cell:
    """Links among the sets of one cell: members of two blocks of a group, or of one."""

    def __init__(self, n: np.ndarray, h: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.n, self.h, self.left, self.right = n, h, left, right
        self.row = np.repeat(np.arange(len(n)), n)
        self.root = np.arange(len(n))

    def alike(self, common, a, b):
        return 100 * common >= LIKENESS * (self.n[a] + self.n[b] - common)

    def join(self, a: np.ndarray, b: np.ndarray):
        """Join the components of linked members (the smallest place is the root)."""
        while len(a):
            x, y = self.root[a], self.root[b]
            if (x == y).all():
                return
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]

    def star(self, k: int):
        own = self.h[self.row == k]
        common = np.bincount(self.row[np.isin(self.h, own)], minlength=len(self.n))
        b = np.flatnonzero(self.alike(common, k, np.arange(len(self.n))))
        self.join(np.full(len(b), k), b)

    def products(self, one: np.ndarray, two: np.ndarray):
        """Link the members ``one`` with the members ``two``."""
        if not len(one) or not len(two):
            return
        use = np.zeros(len(self.n), bool)
        use[one] = use[two] = True
        keep = use[self.row]
        shingle, row = self.h[keep], self.row[keep]
        order = np.argsort(shingle, kind="stable")
        shingle, row = shingle[order], row[order]
        column = np.cumsum(np.append(False, shingle[1:] != shingle[:-1]))
        held = np.bincount(column)
        several = held[column] > 1
        column, row = (np.cumsum(held > 1) - 1)[column[several]], row[several]
        common = np.zeros((len(one), len(two)), np.float32)
        starts = np.searchsorted(column, np.arange(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS))
        for lo, hi in zip(starts, np.append(starts[1:], len(column))):
            m = np.zeros((len(self.n), COLUMNS), np.float32)
            m[row[lo:hi], column[lo:hi] % COLUMNS] = 1
            common += m[one] @ m[two].T  # whole numbers far below 2**24
        i, j = np.nonzero(self.alike(common, one[:, None], two[None, :]))
        self.join(one[i], two[j])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(root, member) of a spanning forest."""
        if len(self.n) > 4 * STARS:
            for k in range(0, len(self.n), max(1, len(self.n) // STARS)):
                self.star(k)
        # all pairs but those inside the largest component
        values, counts = np.unique(self.root, return_counts=True)
        largest = self.root == values[counts.argmax()] if counts.max() > 1 else np.zeros(len(self.n), bool)
        l_in, r_in = largest[self.left], largest[self.right]
        self.products(self.left[~l_in], self.right)
        self.products(self.left[l_in], self.right[~r_in])
        member = np.flatnonzero(self.root != np.arange(len(self.n)))
        return self.root[member], member


def cells_links(t: pa.Table) -> pa.Table:
    """Links of a bucket of cells (cell, id, own, left, n, h)."""
    t = t.sort_by([("cell", "ascending"), ("id", "ascending")]).combine_chunks()
    cell, ident, own, left, n = (t.column(c).to_numpy() for c in ("cell", "id", "own", "left", "n"))
    h = t.column("h").combine_chunks()
    h = (h.chunk(0) if isinstance(h, pa.ChunkedArray) else h).flatten().to_numpy()
    ends = np.cumsum(n)
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in zip(starts, np.append(starts[1:], len(cell))):
        place = np.arange(hi - lo)
        one_block = (own[lo:hi] == own[lo]).all()
        sides = (place, place) if one_block else (place[left[lo:hi]], place[~left[lo:hi]])
        roots, members = Cell(n[lo:hi], h[ends[lo] - n[lo] : ends[hi - 1]], *sides).links()
        a.append(ident[lo + roots])
        b.append(ident[lo + members])
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def group_links(entries: DataFrame, sets: DataFrame, cell: int = CELL) -> DataFrame:
    """(a, b): forests of the links inside the groups of table entries (key, id, first); ``sets``: (id, n, h)."""
    placed = shared(entries.select(F.col("first").alias("key"), "id").distinct())
    placed = stored(placed.select("id", "key", F.floor(F.col("place") / cell).cast("int").alias("own")), "members")
    blocks = placed.groupBy("key").agg(F.max("own").alias("_last")).where("_last > 0").select(F.col("key").alias("_key"), "_last")
    cells = placed.join(blocks, F.col("key") == F.col("_key"), "left").select("key", "id", "own", F.explode(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0)))).alias("other"))
    cells = cells.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "id", "own", (F.col("own") <= F.col("other")).alias("left"))
    rows = cells.join(sets, "id")
    # small cells share a task's call, about BUCKET shingles at a time
    total = cells.join(sets.select("id", "n"), "id").agg(F.sum("n")).first()[0] or 0
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("cell"), F.lit(-(-total // BUCKET) or 1)))
    return rows.select("bucket", "cell", "id", "own", "left", "n", "h").groupBy("bucket").applyInArrow(cells_links, "a long, b long").distinct()


def near_groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    rows = stored(signatures(docs, shingle), "signatures")
    known = rows.where("doc_id is not null and n > 0")
    classes = known.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("doc"), F.first("subs").alias("subs"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    entries = stored(table_entries(classes), "entries")
    members = classes.drop("subs").join(entries.select("id").distinct(), "id", "left_semi")
    sets = stored(whole_sets(docs, members, shingle), "sets")
    roots = stored(components(group_links(entries, sets)), "roots")

    named = classes.select("n", "s1", "s2", "id", "doc").join(roots, F.col("id") == F.col("v"), "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = named.select(F.col("n").alias("_n"), F.col("s1").alias("_s1"), F.col("s2").alias("_s2"), "root").join(least, "root")
    same = (F.col("n") == F.col("_n")) & (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2"))
    out = rows.drop("subs").join(named, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def dedup(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the documents whose component has a smaller doc_id."""
    gone = near_groups(docs, shingle).groupBy("doc_id").agg(F.max("kept").alias("_kept")).where("not _kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
