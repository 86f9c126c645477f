"""Document fingerprints: weighted SimHash and permuted block tables, in DataFrame functions only.

Fingerprint.  A document's terms are its consecutive word pairs (and its last word); a term votes with
its weight, its length in characters up to ``MOST_WEIGHT``, for the set bits of its 64-bit hash
and against the others.  A bit of the fingerprint is set if the votes for it outweigh the rest.
Terms are exploded and summed by Spark in partial aggregates, 32 sums of two lanes per document, so a
document's length is not bounded by memory.

Search.  A fingerprint is cut into ``BLOCKS`` = 6 blocks.  Two fingerprints within ``RADIUS`` = 3 bits agree in
at least three of the six, so one table for each of the 20 choices of three blocks, keyed by those blocks
(the permuted prefix of about 32 bits), finds every fingerprint within the radius; complete distances
are checked in the join.  ``known`` asks for each query whether any fingerprint lies within the radius: a semi
join, so a crowded bucket never multiplies rows, and equal fingerprints are one row.

Editing.  ``edited`` replaces the last floor(n/2) code points of a document with the first of the next
document by doc_id.  Neighbours are found in range buckets of equal depth (two per
shuffle partition; their bounds are the only numbers that the driver sees), each bucket also receiving the first row of the next one; no global sort runs.

Defined cases: null or empty text has no terms and fingerprint zero; a row without doc_id is
left out (it has no place in the order); rows that repeat a doc_id are ordered by text, and equal rows
follow each other, each a row of its own; a single document is its own next; an empty table gives
an empty result.  Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volpanel.llm.common import BLANK_CLASS, shuffle_parts, stored
from volpanel.llm.simhash import majority, vote_sums

MOST_WEIGHT = 32
RADIUS = 3
BLOCKS = 6


# ---- fingerprints --------------------------------------------------------------------

def terms(text: Column) -> Column:
    """Array of the words of ``text``."""
    return F.filter(F.split(text, BLANK_CLASS + "+"), lambda w: w != "")


def weighted(words: Column) -> Column:
    """Array of (h, w): hash and weight of every word with its successor."""
    def one(i):
        a, b = F.element_at(words, i), F.get(words, i)
        size = F.length(a) + F.coalesce(F.length(b), F.lit(0))
        return F.struct(F.xxhash64(a, b).alias("h"), F.least(size, F.lit(MOST_WEIGHT)).cast("long").alias("w"))

    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(1), F.size(words)), one))


def fingerprints(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """keys, fp: the weighted SimHash of ``text`` for every distinct value of ``keys``."""
    words = rows.select(*keys, terms(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
    each = words.select(*keys, F.explode_outer(weighted(F.col("_words"))).alias("_t"))
    flat = each.select(*keys, F.coalesce("_t.h", F.lit(0).cast("long")).alias("_h"), F.coalesce("_t.w", F.lit(0).cast("long")).alias("_w"))
    sums = flat.groupBy(*keys).agg(F.sum("_w").alias("_total"), *vote_sums(F.col("_w"), F.col("_h")))
    return sums.select(*keys, majority(F.col("_total")).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- permuted block tables -------------------------------------------------------------

def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """One mask per table: the bits of ``blocks - radius`` of the blocks."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    return [sum(parts[k] for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def block_tables(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(table, key, fp): every fingerprint in every permuted table."""
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius=radius)]
    entry = F.explode(F.array(*[F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for k, m in enumerate(signed)]))
    return fps.select("fp", entry.alias("e")).select("e.table", "e.key", "fp")


def known(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The distinct fingerprints ``fp`` of ``queries`` that have one of ``fps`` within the radius."""
    own = block_tables(fps.select("fp").distinct(), radius).select(F.col("table").alias("_t"), F.col("key").alias("_k"), F.col("fp").alias("_f"))
    asked = block_tables(queries.select("fp").distinct(), radius)
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("_f"))) <= radius
    return asked.join(own, (F.col("table") == F.col("_t")) & (F.col("key") == F.col("_k")) & near, "left_semi").select("fp").distinct()


# ---- edited texts ----------------------------------------------------------------------

def constants(values: list) -> Column:
    """An array of whole numbers (or nulls) as one constant, folded by the optimiser."""
    return F.split(F.lit(",".join("" if v is None else str(int(v)) for v in values)), ",").try_cast("array<bigint>")


def cuts_up_to(x: Column, bounds: Column, n: int) -> Column:
    """How many of the ``n`` sorted ``bounds`` are at most ``x``: a binary search."""
    if not n:
        return F.lit(0)

    def halve(acc, _):
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        right = (F.get(bounds, mid) <= x) & (acc["lo"] < acc["hi"])
        return F.struct(F.when(right, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(right | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), halve, lambda acc: acc["lo"])


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text, place, next_id, next_text: every row with its successor by (doc_id, text); the last's is the first.
    ``place`` tells equal rows apart.

    ``buckets`` (twice the shuffle partitions if not given) sets how much of the table one window sorts."""
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = buckets or 2 * shuffle_parts(docs.sparkSession)
    cuts = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] if n > 1 else [0.5], min(100 * n, 1_000_000))).first()[0]
    cuts = sorted(set(cuts or []))
    bucket = cuts_up_to(F.col("doc_id"), constants(cuts), len(cuts))
    heads = sorted(rows.select("doc_id").groupBy(bucket.alias("b")).agg(F.min("doc_id").alias("head")).collect())  # one per bucket
    if not heads:
        return rows.select("doc_id", "text", F.lit(0).cast("long").alias("place"), F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"))
    # the row that opens a bucket also goes, as a guest, to the bucket before (the first to the last)
    before = constants(_previous([h.b for h in heads], len(cuts) + 1)).cast("array<int>")
    opens = constants(_heads(heads, len(cuts) + 1))
    home = rows.withColumn("bucket", bucket)
    guest = F.when(F.element_at(opens, F.col("bucket") + 1) == F.col("doc_id"), F.array(F.struct(F.element_at(before, F.col("bucket") + 1).alias("b"), F.lit(1).alias("guest"))))
    places = F.concat(F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("guest"))), F.coalesce(guest, F.array().cast("array<struct<b:int,guest:int>>")))
    placed = home.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.b", "p.guest")
    w = Window.partitionBy("b").orderBy("guest", "doc_id", "text")
    place = F.col("b").cast("long") * F.lit(1 << 40) + F.row_number().over(w)
    return placed.select("doc_id", "text", "guest", place.alias("place"), F.lead("doc_id").over(w).alias("next_id"), F.lead("text").over(w).alias("next_text")).where("guest = 0").drop("guest")


def _previous(present: list[int], n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(present):
        out[b] = present[k - 1]
    return out


def _heads(heads: list, n: int) -> list:
    out = [None] * n
    for h in heads:
        out[h.b] = h.head
    return out


def edited(pairs: DataFrame) -> DataFrame:
    """``pairs`` of ``with_next`` with n_chars and edited: the second half replaced by the next text's start."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = pairs.withColumn("n_chars", F.length("text").cast("long"))
    return rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half)))


def report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, their likeness, the likeness to the next
    document's, and whether any document lies within the radius of the edited text."""
    rows = edited(with_next(docs))
    keys = ["place", "doc_id", "text_key", "next_id", "next_key", "n_chars", "edited_sha256"]
    rows = rows.select("place", "doc_id", F.xxhash64("text").alias("text_key"), "next_id", F.xxhash64("next_text").alias("next_key"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "text", "edited")
    both = rows.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("body")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")))).alias("v")).select(*keys, "v.which", "v.body")
    fps = fingerprints(both, "body", [*keys, "which"])
    out = stored(fps.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp")), "fingerprints")
    own = out.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("fp").alias("next_fp")).distinct()
    found = known(out.select(F.col("edited_fp").alias("fp")), out.select("fp"), radius).select(F.col("fp").alias("_found"))
    joined = out.join(own, (F.col("next_id") == F.col("_id")) & (F.col("next_key") == F.col("_key")), "left").join(found, F.col("edited_fp") == F.col("_found"), "left")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), F.col("_found").isNotNull().alias("edited_known"))
