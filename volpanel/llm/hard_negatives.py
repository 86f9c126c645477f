"""Hard-negative mining with rotated one-bit codes.

Every usable vector becomes integers, floor(256 * x).  It is turned by one seeded orthogonal matrix and stored
with one bit per dimension (the sign) and its alignment, the inner product with the unit vector c that the bits
stand for.  So x = align * c + r with r at a right angle to c, of known length.

For an anchor y, popcounts of the code against the bit planes of y (``PLANES`` bits a component) estimate
g = <c, y>; how far the planes are from y is known, too.  By Cauchy-Schwarz
    <x, y> = align * g + <r, y>,   |<r, y>| <= |r| * sqrt(|y|**2 - g**2),
an interval that holds the score for certain.  Rows whose interval can't reach the answer are passed over; the others
are scored in integers.  The intervals decide nothing else: results are exact.  In few dimensions and without
clear neighbours the intervals are wide and most rows are scored.

Two searches of all rows are made: the anchor's first positives, then, with their scores known, the first negatives inside each
positive's window.  Rows are dealt to blocks of about ``BLOCK_ROWS``; a task holds one block and streams the anchors
from the shared folder, ``CHUNK`` at a time.  Few blocks are dealt to several tasks, each with a part of the anchors.  A
task hands out at most the wanted number of rows for an anchor and positive, so no label and no group of equal vectors
meets in one task.

Defined cases: rows with a null vec_id, label or vector, or a component that is null or not finite (also times 256), take no
part; vectors meet anchors of their own length only; equal scores are ordered by vec_id, so repeated rows stand side by
side, each as a row of its own; an anchor is never its own positive, but a repeated row of it is; an anchor without
positives, or a positive without negatives in its window, has no rows; a score beyond a long is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volpanel.llm.common import shuffle_parts, stored, worker_fs

ANCHOR_STEP = 50  # anchors: vec_id divisible by this
SHIFT_STEP = 7  # vec_id divisible by this: the label moves on by one
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # a negative's score in per cent of the positive's
PLANES = 6
BLOCK_ROWS = 32_768
CHUNK = 32
EXACT = 1 << 53


def rotation(dims: int) -> np.ndarray:
    """A seeded orthogonal matrix; dims is a multiple of 64."""
    q, r = np.linalg.qr(np.random.default_rng(12).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def turned(x: np.ndarray) -> np.ndarray:
    """Rows of x, padded to whole words, turned."""
    dims = max(64, -(-x.shape[1] // 64) * 64)
    return np.pad(x, ((0, 0), (0, dims - x.shape[1]))) @ rotation(dims).T


def bits(b: np.ndarray) -> np.ndarray:
    return np.packbits(b, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """Rows with codes: words of signs, alignment, length of the residual."""

    def __init__(self, x: np.ndarray):
        t = turned(x)
        self.x, self.dims = x, t.shape[1]
        self.words = bits(t > 0)
        self.ones = np.bitwise_count(self.words).sum(axis=1).astype(np.float64)
        self.align = ((2.0 * (t > 0) - 1) * t).sum(axis=1) / np.sqrt(self.dims)
        self.rest = np.sqrt(np.maximum(0.0, (t * t).sum(axis=1) - self.align**2))

    def of(self, at: np.ndarray) -> "Codes":
        part = object.__new__(Codes)
        part.dims = self.dims
        for name in ("x", "words", "ones", "align", "rest"):
            setattr(part, name, getattr(self, name)[at])
        return part

    def intervals(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores, anchors x rows."""
        t = turned(y)
        low = t.min(axis=1, keepdims=True)
        step = np.maximum(t.max(axis=1, keepdims=True) - low, 1e-30) / ((1 << PLANES) - 1)
        u = np.rint((t - low) / step).astype(np.int64)
        near = low + step * u
        off = np.sqrt(((t - near) ** 2).sum(axis=1))[:, None]
        size = (t * t).sum(axis=1)[:, None]
        hit = np.zeros((len(y), len(self.x)), np.int64)
        for k in range(PLANES):
            plane = bits((u >> k & 1).astype(bool))
            for w in range(plane.shape[1]):
                hit += np.bitwise_count(self.words[None, :, w] & plane[:, w, None]).astype(np.int64) << k
        on_bits = low * self.ones[None, :] + step * hit
        g = (2 * on_bits - near.sum(axis=1, keepdims=True)) / np.sqrt(self.dims)
        least = np.maximum(0.0, np.abs(g) - off)
        width = self.align[None, :] * off + self.rest[None, :] * np.sqrt(np.maximum(0.0, size - least**2))
        # rounding of the sums above, far below this
        width += 1e-9 * (np.sqrt(size) * (self.align + self.rest)[None, :] + 1)
        return self.align[None, :] * g - width, self.align[None, :] * g + width


def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products of rows x with one anchor y (whole numbers as doubles)."""
    if not x.size or np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, x.shape[1]) < EXACT:
        return (x @ y).astype(np.int64)
    anchor = [int(v) for v in y]
    exact = [sum(int(a) * b for a, b in zip(row, anchor)) for row in x]
    if any(not -(1 << 63) <= s < 1 << 63 for s in exact):
        raise OverflowError("a score does not fit a long")
    return np.array(exact, np.int64)


def first_of(score: np.ndarray, ident: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, equal ones by smaller id."""
    if len(score) > n:
        limit = np.partition(score, len(score) - n)[len(score) - n]
        at = np.flatnonzero(score >= limit)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ident[at], -score[at]))][:n]


def nth_highest(values: np.ndarray, n: int) -> float:
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


# ---- rows ------------------------------------------------------------------------------

def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """rid, vec_id, label, dims, x: the rows that take part, as whole numbers."""
    grid = F.transform(F.col(vector), lambda v: F.floor(F.lit(256.0) * v.cast("double")).cast("double"))
    whole = F.transform(F.col(vector), lambda v: F.lit(256.0) * v.cast("double"))
    finite = F.forall(whole, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # beyond 2**53 doubles are whole numbers, and floor would go through a long
    big = F.transform(whole, lambda v: F.when(F.abs(v) < float(EXACT), F.floor(v).cast("double")).otherwise(v))
    label = F.when(F.col("vec_id") % SHIFT_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()).where(finite)
    small = F.forall(whole, lambda v: F.abs(v) < float(EXACT))
    return good.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.size(vector).alias("dims"), F.when(small, grid).otherwise(big).alias("x"))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def anchors_of(path: str, dims: int, part: int, parts: int, columns: list[str]):
    """Tables of at most CHUNK anchors of one length and one part."""
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    files, where = worker_fs(path)
    for b in ds.dataset(where, filesystem=files, format="parquet").to_batches(columns=columns, filter=pc.field("dims") == dims, batch_size=4096):
        t = pa.Table.from_batches([b])
        t = t.filter(pa.array(t.column("rid").to_numpy() % parts == part))
        for lo in range(0, t.num_rows, CHUNK):
            yield t.slice(lo, CHUNK)


FOUND = "rid long, slot int, score long, vec_id long"


def searched(rows: DataFrame, path: str, columns: list[str], pick) -> DataFrame:
    """FOUND rows of all blocks; ``pick`` (block, label starts, anchors) yields (anchor row, slot, scores, ids)."""
    spark = rows.sparkSession
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    parts = max(1, -(-shuffle_parts(spark) // blocks))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def run(key, t):
        dims, part = key[1].as_py(), key[2].as_py()
        t = t.sort_by([("label", "ascending"), ("rid", "ascending")])
        rid, ident, label = (t.column(c).to_numpy() for c in ("rid", "vec_id", "label"))
        codes = Codes(matrix(t.column("x"), dims))
        out = {c: [np.zeros(0, np.int64)] for c in ("rid", "slot", "score", "vec_id")}
        for a in anchors_of(path, dims, part, parts, columns):
            for who, slot, score, ids in pick(codes, rid, ident, label, a, matrix(a.column("x"), dims)):
                for c, v in zip(out, (np.full(len(score), who), np.full(len(score), slot), score, ids)):
                    out[c].append(v)
        made = {c: np.concatenate(v).astype(np.int64) for c, v in out.items()}
        return pa.table(made | {"slot": made["slot"].astype(np.int32)})

    return dealt.groupBy("block", "dims", "part").applyInArrow(run, FOUND)


def pick_positives(codes, rid, ident, label, anchors, y):
    """The first POSITIVES rows of each anchor's label, but for the anchor itself."""
    own = anchors.column("label").to_numpy()
    names = anchors.column("rid").to_numpy()
    for value in np.unique(own):
        lo, hi = np.searchsorted(label, value), np.searchsorted(label, value, side="right")
        if lo == hi:
            continue
        some = np.flatnonzero(own == value)
        part = codes.of(slice(lo, hi))
        low, high = part.intervals(y[some])
        for k, a in enumerate(some):
            low[k, rid[lo:hi] == names[a]] = high[k, rid[lo:hi] == names[a]] = -np.inf
            at = np.flatnonzero((high[k] >= nth_highest(low[k], POSITIVES)) & (high[k] > -np.inf))
            got = scores(part.x[at], y[a])
            best = first_of(got, ident[lo:hi][at], POSITIVES)
            yield names[a], 0, got[best], ident[lo:hi][at][best]


def pick_negatives(codes, rid, ident, label, anchors, y):
    """For each positive the first NEGATIVES rows of other labels inside its window."""
    names, own = anchors.column("rid").to_numpy(), anchors.column("label").to_numpy()
    wanted = anchors.column("scores").to_pylist()
    low, high = codes.intervals(y)
    for k, (who, value) in enumerate(zip(names, own)):
        lo, hi = np.searchsorted(label, value), np.searchsorted(label, value, side="right")
        low[k, lo:hi] = high[k, lo:hi] = -np.inf  # the anchor's own label
        use = np.zeros(len(rid), bool)
        for s in wanted[k]:
            if s < 0:
                continue  # the window is empty
            inside = low[k][(low[k] >= LOW * s / 100 + 1) & (high[k] <= HIGH * s / 100 - 1)]
            use |= (high[k] >= max(LOW * s / 100 - 1, nth_highest(inside, NEGATIVES))) & (low[k] <= HIGH * s / 100 + 1)
        at = np.flatnonzero(use)
        got, ids = scores(codes.x[at], y[k]), ident[at]
        for slot, s in enumerate(wanted[k]):
            # LOW * s <= 100 * score <= HIGH * s in whole numbers
            fit = np.flatnonzero((got >= -(-LOW * s // 100)) & (got <= HIGH * s // 100))
            best = fit[first_of(got[fit], ids[fit], NEGATIVES)]
            yield who, slot, got[best], ids[best]


def mine(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    from volpanel.llm.common import shared_path

    spark = rows.sparkSession
    all_rows = stored(usable(rows, vector), "vectors")
    anchors = all_rows.where(F.col("vec_id") % ANCHOR_STEP == 0)
    path = shared_path(spark, "anchors")
    anchors.write.parquet(path)
    found = searched(all_rows, path, ["rid", "label", "dims", "x"], pick_positives)
    first = Window.partitionBy("rid").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= POSITIVES)
    lists = found.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("place", "score", "vec_id"))).alias("p"))
    lists = lists.select("rid", F.col("p.score").alias("scores"), F.col("p.vec_id").alias("ids"))
    targets = shared_path(spark, "targets")
    anchors.join(lists, "rid").write.parquet(targets)

    found = searched(all_rows, targets, ["rid", "label", "dims", "x", "scores"], pick_negatives)
    first = Window.partitionBy("rid", "slot").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    known = spark.read.parquet(targets).select("rid", F.col("vec_id").alias("anchor_id"), "scores", "ids")
    return found.join(known, "rid").select(
        "anchor_id", F.col("ids")[F.col("slot")].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("scores")[F.col("slot")].alias("positive_score"), F.col("score").alias("negative_score"))
