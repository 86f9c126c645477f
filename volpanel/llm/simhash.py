"""SimHash near-dedup by multi-index hashing.

Fingerprints are made by DataFrame functions: shingle hashes are exploded and their bits counted in
``LANES`` sums per document (two 32-bit lanes in a long), so a document of any length is a partial
aggregate of one row per task.

Links.  Two fingerprints link at ``RADIUS`` = 3 or fewer differing bits.  Equal fingerprints are one
class first, so a group of copies is one row from here on.  A fingerprint is cut into two 32-bit
segments; of two linked fingerprints one segment pair differs in at most one bit (3 // 2).  So each
fingerprint is entered into the table of each segment, and searches it with the 33 values of the
Hamming ball of radius 1 around its own segment; the matches of a table entry are verified on all 64
bits.  No link is lost.

A table entry (segment value) with its searches is worked on in one task only up to ``ENTRY`` rows:
larger entries are dealt to a grid of sub-entries (members by members' hash, searches by
searches' hash), so that every member still meets every search and no task holds an unbounded group.
A task does not emit the pairs that it verifies but a spanning forest of them, which has the same
connected components and fewer rows than the entry.

Components are found by alternating large-star and small-star steps (Kiveris et al., 2014) on the
forest edges; each round is written to the shared folder.

Defined cases: null, empty or blank text has fingerprint zero and links like any other; fewer words
than a shingle form one shingle; repeated rows of a doc_id with equal texts share a fingerprint (the
votes are scaled alike); rows that repeat a doc_id with other texts vote together; rows without
doc_id are kept apart: they get a fingerprint of their own, no component and are never dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from volpanel.llm.common import BLANK_CLASS, ascii_lower, group_min, shuffle_parts, stored

SHINGLE = 3
RADIUS = 3
LANES = 32
ENTRY = 4096


# ---- fingerprints (DataFrame functions) -----------------------------------------------

def shingle_hashes(words: Column, n: int) -> Column:
    """XXH64 (seed 42) of every n consecutive words joined by a space; the whole if fewer."""
    long_enough = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i, n))))
    return F.when(F.size(words) >= n, long_enough).when(F.size(words) > 0, F.array(F.xxhash64(F.concat_ws(" ", words)))).otherwise(F.array().cast("array<bigint>"))


def vote_sums(weight: Column, h: Column) -> list[Column]:
    """Weighted counts of set bits, as LANES sums of two lanes: bit j in the low and j + 32 in the high half."""
    mask = F.lit((1 << 32) | 1)
    return [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(mask) * weight).alias(f"_v{k}") for k in range(LANES)]


def majority(total: Column) -> Column:
    """The fingerprint: bit j is set if its count is over half of ``total``; sums as in ``vote_sums``."""
    out = F.lit(0).cast("long")
    for k in range(LANES):
        low, high = F.col(f"_v{k}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(F.col(f"_v{k}"), 32)
        for j, votes in ((k, low), (k + 32, high)):
            bit = 1 << j if j < 63 else -(1 << 63)
            out = out.bitwiseOR(F.when(votes * 2 > total, F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (long): one row per distinct doc_id, and one per row without doc_id."""
    text = F.coalesce(ascii_lower(F.col("text")), F.lit(""))
    alone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("_row")
    words = docs.select("doc_id", alone, F.filter(F.split(text, BLANK_CLASS + "+"), lambda w: w != "").alias("words"))
    rows = words.select("doc_id", "_row", F.explode_outer(shingle_hashes(F.col("words"), shingle)).alias("h"))
    sums = rows.groupBy("doc_id", "_row").agg(F.count("h").alias("_n"), *vote_sums(F.lit(1).cast("long"), F.coalesce("h", F.lit(0).cast("long"))))
    return sums.select("doc_id", majority(F.col("_n")).alias("fp"))


# ---- links -----------------------------------------------------------------------------

def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (smallest index) of an edge list, by label propagation with jumps."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def forest(members: np.ndarray, searches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (smallest fingerprint, other) of the components among verified pairs."""
    values = np.unique(np.concatenate([members, searches]))
    ai, bi = [], []
    at_m, at_s = np.searchsorted(values, members), np.searchsorted(values, searches)
    step = max(1, 2_000_000 // max(1, len(members)))
    for lo in range(0, len(searches), step):
        near = np.bitwise_count(searches[lo : lo + step, None] ^ members[None, :]) <= RADIUS
        i, j = np.nonzero(near)
        a, b = at_s[lo + i], at_m[j]
        ai.append(a[a != b])
        bi.append(b[a != b])
        if sum(map(len, ai)) > 4_000_000:  # keep memory bounded: replace the pairs by their forest
            root = _roots(len(values), np.concatenate(ai), np.concatenate(bi))
            own = np.flatnonzero(root != np.arange(len(root)))
            ai, bi = [own], [root[own]]
    root = _roots(len(values), np.concatenate(ai), np.concatenate(bi)) if ai else np.arange(len(values))
    own = np.flatnonzero(root != np.arange(len(root)))
    return values[root[own]], values[own]


def segment_rows(fps: DataFrame) -> DataFrame:
    """(seg, value, fp, member): table entries (member) and the searches of the ball of radius 1."""
    low, high = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(F.col("fp"), 32)
    both = F.explode(F.array(F.struct(F.lit(0).alias("seg"), low.alias("v")), F.struct(F.lit(1).alias("seg"), high.alias("v"))))
    own = fps.select("fp", both.alias("s")).select("fp", "s.seg", "s.v")
    ball = F.explode(F.array(F.lit(0).cast("long"), *[F.lit(1 << k).cast("long") for k in range(32)])).alias("flip")
    return own.select("seg", "fp", "v", ball).select("seg", F.col("v").bitwiseXOR(F.col("flip")).alias("value"), "fp", (F.col("flip") == 0).alias("member"))


def links(fps: DataFrame, entry: int = ENTRY) -> DataFrame:
    """(a, b): forest edges between distinct fingerprints with at most RADIUS differing bits."""
    spark = fps.sparkSession
    parts = shuffle_parts(spark)
    low, high = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(F.col("fp"), 32)
    # entries whose searches can pass the bound: at most 33 members' entries search one
    halves = fps.select(F.explode(F.array(F.struct(F.lit(0).alias("seg"), low.alias("v")), F.struct(F.lit(1).alias("seg"), high.alias("v")))).alias("s")).select("s.*")
    crowded = halves.groupBy("seg", "v").count().where(F.col("count") > entry // 64)
    ball = F.explode(F.array(F.lit(0).cast("long"), *[F.lit(1 << k).cast("long") for k in range(32)])).alias("flip")
    # an entry's members are those of its value, its searches those of the 33 values around it
    around = crowded.select("seg", "v", "count", ball).select("seg", F.col("v").bitwiseXOR(F.col("flip")).alias("value"), "count")
    sizes = around.groupBy("seg", "value").agg(F.sum("count").alias("n"))
    grid = stored(sizes.where(F.col("n") > entry).select(F.col("seg").alias("_seg"), F.col("value").alias("_value"), F.ceil(F.col("n") / entry).cast("int").alias("side")), "crowded")
    rows = segment_rows(fps).join(grid, (F.col("seg") == F.col("_seg")) & (F.col("value") == F.col("_value")), "left").drop("_seg", "_value")
    side = F.coalesce("side", F.lit(1))
    line = F.pmod(F.xxhash64("fp"), side).cast("int")
    # members take a row of the grid, searches a column; a member searches its own entry, too
    as_member = rows.where("member").select("seg", "value", "fp", F.lit(True).alias("member"), line.alias("x"), F.explode(F.sequence(F.lit(0), side - 1)).alias("y"))
    as_search = rows.select("seg", "value", "fp", F.lit(False).alias("member"), F.explode(F.sequence(F.lit(0), side - 1)).alias("x"), line.alias("y"))
    dealt = as_member.unionByName(as_search).withColumn("key", F.xxhash64("seg", "value", "x", "y")).select("key", "fp", "member")

    def run(batches):
        key, fp, member = [], [], []
        for b in batches:
            key.append(b.column(0).to_numpy())
            fp.append(b.column(1).to_numpy())
            member.append(b.column(2).to_numpy(zero_copy_only=False))
        if not key:
            return
        key, fp, member = np.concatenate(key), np.concatenate(fp).view(np.uint64), np.concatenate(member)
        known = np.isin(key, key[member])  # searches that meet an entry
        key, fp, member = key[known], fp[known], member[known]
        order = np.argsort(key, kind="stable")
        key, fp, member = key[order], fp[order], member[order]
        cuts = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(key))
        # an entry where the only search is the member itself has no pair
        out_a, out_b = [], []
        for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            m = member[s:e]
            a, b = forest(fp[s:e][m], fp[s:e][~m])
            out_a.append(a)
            out_b.append(b)
        if out_a:
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(out_a).view(np.int64), "b": np.concatenate(out_b).view(np.int64)})

    return dealt.repartition(parts, "key").mapInArrow(run, "a long, b long").distinct()


# ---- components -------------------------------------------------------------------------

def _hung(edges: DataFrame, name: str) -> DataFrame:
    """(v, u, least): both directions with the smallest vertex of v's closed neighbourhood."""
    return group_min(edges, ["v"], "u", "_m").withColumn(name, F.least("v", "_m")).drop("_m")


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(v, root) for vertices of ``edges`` (columns a, b) that are not their component's smallest."""
    def both(e):
        return e.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(e.select(F.col("b").alias("v"), F.col("a").alias("u")))

    edges, mark = stored(edges.where("a <> b"), "edges"), None
    for _ in range(most_rounds):
        # large star: every larger neighbour of v moves to the least of v's neighbourhood
        large = _hung(both(edges), "least").where(F.col("u") > F.col("v")).select(F.col("least").alias("a"), F.col("u").alias("b")).where("a <> b").distinct()
        # small star: v and its smaller neighbours move to the least of them
        down = large.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        small = _hung(down, "least")
        edges = stored(small.select(F.col("least").alias("a"), "u", "v").select(F.explode(F.array(F.struct("a", F.col("u").alias("b")), F.struct("a", F.col("v").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("b").alias("v"), F.col("a").alias("root"))
        mark = tuple(now)
    raise RuntimeError("components did not settle")


def near_groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id: component_id is the smallest doc_id reachable over links."""
    made = stored(fingerprints(docs, shingle), "fingerprints")
    fps = made.where("doc_id is not null")
    firsts = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    edges = links(firsts.select("fp"))
    # from fingerprints to their classes' first documents, so that the smallest vertex is the answer
    named = firsts.select(F.col("fp").alias("_fp"), "first")
    edges = edges.join(named, F.col("a") == F.col("_fp")).select(F.col("first").alias("a"), "b").join(named, F.col("b") == F.col("_fp")).select("a", F.col("first").alias("b"))
    roots = components(edges)
    out = group_min(fps, ["fp"], "doc_id", "first")
    grouped = out.join(roots, F.col("first") == F.col("v"), "left").select("doc_id", "fp", F.coalesce("root", "first").alias("component_id"))
    alone = made.where("doc_id is null").select("doc_id", "fp", F.lit(None).cast(grouped.schema["component_id"].dataType).alias("component_id"))
    return grouped.unionByName(alone)


def dedup(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one document (the smallest doc_id) of each group; rows that repeat its doc_id stay with it."""
    groups = near_groups(docs, shingle)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
