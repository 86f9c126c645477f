"""Cross-tokenizer alignment over distinct texts.

1. Documents are shuffled by their full text, counted on the map side first, so that each distinct text is
   one row with its multiplicity and a hot text is one row per task.
2. A distinct text is tokenised and aligned once.  Both tokenizers end a token before every single space between two
   visible characters (A's rule never lets a piece run past such a place, B has no piece with a space inside), so the text is cut
   there into units (a space and what follows); a task tokenises and aligns each distinct unit of a block of
   texts once.  A block is a bounded part of a task's texts (``BLOCK_BYTES``, ``BLOCK_UNITS``); after it
   everything is dropped.
3. A block hands out its distinct id pairs, each with its links weighted by the texts' multiplicity, and per text the units
   that it is made of.  The corpus-wide counts are sums of the pairs over blocks: a pair's row count is
   bounded by the blocks, whatever the number of documents.
4. Counts go back to the pairs of each block, and the block's texts sum them.  The measures are joined to doc_ids by the
   SHA-256 of the text; a text of very many documents is joined in ``SALTS`` parts.

Byte offsets where tokens of both end cut the tokens into groups; a link is a pair of occurrences with overlapping
byte ranges.

Defined cases: null and empty texts, and texts whose tokens of A or B don't spell a space and the text (as with a
U+2581 in them), have no tokens: zeros and an empty ``groups_sha256``.  Repeated rows count once each and get
equal results; a row without doc_id counts like any other and is returned without one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volpanel.llm.common import stored

BLOCK_BYTES = 32_000_000
BLOCK_UNITS = 200_000
SALTS = 64
B_BITS = 20  # a pair of ids is one number: A's id above, B's id in the lowest bits
#: single spaces between visible characters
CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """Tokens, groups and links of units (texts that start where both tokenizers cut)."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        if path_a is None or path_b is None:
            import public_tokenizers

            path_a, path_b = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = byte_of_char()
        self.bytes_a = {i: bytes(of[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.length_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        self.length_a[list(self.bytes_a)] = [len(t) for t in self.bytes_a.values()]
        self.bytes_b = [self.piece_bytes(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)

    @staticmethod
    def piece_bytes(piece: str, is_byte: bool) -> bytes:
        return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()

    def ids_a(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A of all units in a row, and each unit's number of bytes.

        Units without white space at their ends are tokenised as one text, which A cuts before each of them."""
        plain = [k for k, u in enumerate(units) if not (u[:1].isspace() or u[-1:].isspace() or not u)]
        texts = [" " + " ".join([units[k] for k in plain[lo : lo + 1000]]) for lo in range(0, len(plain), 1000)]
        got = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(got), np.int64)
        lengths = np.fromiter((len(u.encode()) + 1 for u in units), np.int64, len(units))
        if len(plain) == len(units):
            return flat, lengths
        # put the others, tokenised one by one, back into their places
        ends = np.cumsum(self.length_a[flat])
        stops = np.searchsorted(ends, np.cumsum(lengths[plain])) + 1
        parts = dict(zip(plain, np.split(flat, stops[:-1])))
        odd = [k for k in range(len(units)) if k not in parts]
        parts |= {k: np.array(e.ids, np.int64) for k, e in zip(odd, self.a.encode_batch_fast([" " + units[k] for k in odd], add_special_tokens=False))}
        return np.concatenate([parts[k] for k in range(len(units))]), lengths

    def __call__(self, units: list[str]) -> "Aligned":
        """Tokens and links of units, each given without the space that stands before it."""
        a, length = self.ids_a(units)
        of_b = self.b.encode(units, num_threads=1)
        n_b = np.fromiter(map(len, of_b), np.int64, len(of_b))
        b = np.fromiter(chain.from_iterable(of_b), np.int64, int(n_b.sum()))
        # A spells every text; where B does not, the unit is left out
        sums = np.concatenate([[0], np.cumsum(self.length_b[b])])
        stops = np.concatenate([[0], np.cumsum(n_b)])
        good = sums[stops[1:]] - sums[stops[:-1]] == length
        spelled = b"".join([self.bytes_b[i] for i in b[np.repeat(good, n_b)].tolist()])
        if spelled != b"".join([b" " + u.encode() for u, g in zip(units, good.tolist()) if g]):
            good &= np.array([b"".join([self.bytes_b[i] for i in ids]) == b" " + u.encode() for u, ids in zip(units, of_b)])
        unit_a = np.searchsorted(np.cumsum(length), np.cumsum(self.length_a[a]))
        if not good.all():
            a, unit_a, b = a[good[unit_a]], unit_a[good[unit_a]], b[np.repeat(good, n_b)]
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # every stretch between neighbouring token ends is the overlap of one token of A and one of B
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two sorted runs
        ends = ends[np.append(True, ends[1:] != ends[:-1])[: len(ends)]]
        i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        both = end_a[end_b[np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)] == end_a] if len(end_b) else end_a
        last_a, last_b = np.searchsorted(end_a, both) + 1, np.searchsorted(end_b, both) + 1
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, lo_a, lo_b = [], 0, 0
        for hi_a, hi_b in zip(last_a.tolist(), last_b.tolist()):
            one = names_a[lo_a] if hi_a == lo_a + 1 else ",".join(names_a[lo_a:hi_a])
            groups.append(f"{one}|{names_b[lo_b]}" if hi_b == lo_b + 1 else f"{one}|{','.join(names_b[lo_b:hi_b])}")
            lo_a, lo_b = hi_a, hi_b
        n = len(units)
        unit_group = unit_a[last_a - 1]
        counts = [np.bincount(u, minlength=n) for u in (unit_a, np.repeat(np.arange(n), n_b)[np.repeat(good, n_b)], unit_group, unit_a[i])]
        stops = np.concatenate([[0], np.cumsum(counts[2])]).tolist()
        sizes = np.stack(counts, axis=1).astype(np.int64)
        sizes[~good] = -1
        return Aligned([";".join(groups[x:y]) for x, y in zip(stops[:-1], stops[1:])], sizes, unit_a[i], a[i] << B_BITS | b[j])


class Aligned:
    """Of units: groups as text, sizes (tokens of A, of B, groups, links; -1 where B does not spell the unit), and
    links in order, as (unit, pair of ids)."""

    def __init__(self, groups: list[str], sizes: np.ndarray, link_unit: np.ndarray, link_pair: np.ndarray):
        self.groups, self.sizes, self.link_unit, self.link_pair = groups, sizes, link_unit, link_pair


class Block:
    """Distinct units and links of one block of texts."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.at, self.bytes = aligner, {}, 0
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.found: list[tuple[np.ndarray, np.ndarray]] = []  # links, as (unit, pair)
        self.seen = np.zeros(0, np.int64)  # of a unit: its occurrences, weighted

    def learn(self, units: list[str]):
        got = self.aligner(units)
        first = len(self.at)
        self.at.update(zip(units, range(first, first + len(units))))
        self.groups += got.groups
        self.sizes = np.concatenate([self.sizes, got.sizes])
        self.seen = np.append(self.seen, np.zeros(len(units), np.int64))
        self.found.append((got.link_unit + first, got.link_pair))

    def texts(self, texts: list, weights: list[int]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, units) of each text."""
        split = [CUT.split(t) if t else [] for t in texts]
        new = set(chain.from_iterable(split)).difference(self.at)
        if new:
            self.learn(list(new))
        self.bytes += sum(map(len, filter(None, texts)))
        none = np.zeros(0, np.int64)
        out = []
        for s, weight in zip(split, weights):
            own = np.fromiter(map(self.at.__getitem__, s), np.int64, len(s))
            sizes = self.sizes[own]
            if not len(own) or sizes.min() < 0:
                out.append((0, 0, 0, 0, "", none))
                continue
            np.add.at(self.seen, own, weight)
            groups = ";".join(map(self.groups.__getitem__, own.tolist()))
            out.append((*sizes.sum(axis=0).tolist(), hashlib.sha256(groups.encode()).hexdigest(), own))
        return out

    def full(self) -> bool:
        return self.bytes >= BLOCK_BYTES or len(self.at) >= BLOCK_UNITS

    def links(self):
        """(pair, weighted links, units) of the pairs that a counted unit holds."""
        if not self.found:
            return
        unit, pair = (np.concatenate(c) for c in zip(*self.found))
        use = self.seen[unit] > 0
        unit, pair = unit[use], pair[use]
        order = np.argsort(pair, kind="stable")
        unit, pair = unit[order], pair[order]
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
        for lo, hi in zip(starts.tolist(), np.append(starts[1:], len(pair)).tolist()):
            yield int(pair[lo]), int(self.seen[unit[lo:hi]].sum()), unit[lo:hi]


def packed(numbers: np.ndarray) -> bytes:
    """Small whole numbers in few bytes: their four bytes as four runs, compressed."""
    runs = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd", 1).compress(runs.tobytes(), asbytes=True)


def unpacked(column) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all rows, how many each has) of a column of (n, packed)."""
    codec, out = pa.Codec("zstd", 1), []
    for n, data in column:
        raw = np.frombuffer(codec.decompress(data, 4 * n, asbytes=True), np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(4, n).T).view("<u4").reshape(-1))
    return (np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)), np.array([n for n, _ in column], np.int64)


MADE = "block string, sha string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, weight long, n_units long, units binary"


def aligned(texts: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Rows of texts (``sha`` set) and of id pairs (``pair`` set) from distinct texts (text, sha, mult)."""
    names = [c.split()[0] for c in MADE.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in MADE.split(", ")])

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names}, schema)

    def run(batches):
        import uuid

        aligner, block, name = Aligner(path_a, path_b), None, None
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            lo = 0
            while lo < len(columns[0]):
                if block is None:
                    block, name = Block(aligner), uuid.uuid4().hex
                # a step is a few hundred texts, or one very long one
                hi, size = lo, 0
                while hi < len(columns[0]) and hi - lo < 500 and size < BLOCK_BYTES // 8:
                    size += len(columns[0][hi] or "")
                    hi += 1
                got = block.texts(columns[0][lo:hi], columns[2][lo:hi])
                yield batch([dict(zip(names[:7], (name, sha, *g))) | {"n_units": len(g[5]), "units": packed(g[5])} for sha, g in zip(columns[1][lo:hi], got)])
                lo = hi
                if block.full():
                    yield from pairs(name, block)
                    block = None
        if block is not None:
            yield from pairs(name, block)

    def pairs(name, block):
        rows = []
        for p, weight, units in block.links():
            rows.append({"block": name, "pair": p, "weight": weight, "n_units": len(units), "units": packed(units)})
            if len(rows) == 20_000:
                yield batch(rows)
                rows = []
        yield batch(rows)

    return texts.select("text", "sha", "mult").mapInArrow(run, MADE)


def summed(key, texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """sha, n_best, count_sum of one block's texts."""
    flat, lengths = unpacked(list(zip(*(pairs.column(c).to_pylist() for c in ("pair_n", "pair_units")))))
    use, sizes = unpacked(list(zip(*(texts.column(c).to_pylist() for c in ("n_units", "units")))))
    known = int(max(flat.max(initial=-1), use.max(initial=-1))) + 1
    best, total = np.zeros(known, np.int64), np.zeros(known, np.int64)
    np.add.at(best, flat, np.repeat(pairs.column("best").to_numpy().astype(np.int64), lengths))
    np.add.at(total, flat, np.repeat(pairs.column("total").to_numpy(), lengths))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    sums = [np.append(0, np.cumsum(x[use])) for x in (best, total)]
    return pa.table({"sha": texts.column("sha")} | {n: s[ends[1:]] - s[ends[:-1]] for n, s in zip(("n_best", "count_sum"), sums)})


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, total, best: corpus-wide links of each id pair, and if that is its B id's highest."""
    totals = stored(rows.groupBy("pair").agg(F.sum("weight").alias("total")), "pairs")
    of_b = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    top = totals.groupBy(of_b.alias("_b")).agg(F.max("total").alias("_top"))
    # at most one row per id of B's vocabulary
    return totals.join(F.broadcast(top), of_b == F.col("_b")).select("pair", "total", (F.col("total") == F.col("_top")).alias("best"))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of ``docs``.

    The paths are the vocabulary files as the workers see them; without them each worker asks its own installation."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = rows.groupBy("text").agg(F.count(F.lit(1)).alias("mult")).select("text", F.sha2("text", 256).alias("sha"), "mult")
    made = stored(aligned(texts, path_a, path_b), "aligned")
    texts = made.where("sha is not null").select("block", "sha", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_units", "units")
    own = made.where("pair is not null").select("block", "pair", "weight", "n_units", "units")
    counted = own.drop("weight").join(pair_counts(own), "pair").select(F.col("block").alias("own_block"), F.col("n_units").alias("pair_n"), F.col("units").alias("pair_units"), "total", "best")
    sums = texts.select("block", "sha", "n_units", "units").groupBy("block").cogroup(counted.groupBy("own_block")).applyInArrow(summed, "sha string, n_best long, count_sum long")
    measures = stored(texts.drop("block", "n_units", "units").join(sums, "sha"), "measures")

    salted = rows.select("doc_id", F.sha2("text", 256).alias("sha"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    parts = salted.select("sha", "salt").distinct().join(measures, "sha")
    return salted.join(parts, ["sha", "salt"]).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
