"""Best-fit packing of tokenised documents into sequences by swap-based local search.

1. ``pieces`` tokenises every whole text (plus the end id), cuts only documents longer than a
   sequence, and returns a few numbers per piece; token ids never leave the task that made them.
2. Full-length pieces are sequences of their own.  The others are dealt by a hash to groups of about
   ``GROUP_PIECES`` pieces.  A group is packed by best-fit decreasing and then improved: while an
   exchange of one piece for one, of two for one, or a move raises the sum of squared fills of
   the underfull bins, it is made, which drives the emptiest bins to nothing.
3. The bins that are still underfull are opened again and packed with those of other groups, in
   fewer and fewer groups, until one group is left, or a round leaves nearly all its pieces in underfull bins (pieces that
   can't be combined): only the last round can end with free space that another group could have used.

Only (piece, length) rows are shuffled.  No group depends on a key of the data, so no hot key
exists.  Group sizes are bounded in every round.

Defined cases: null or empty text is one piece holding just the end id; repeated rows are packed row
by row (``row_id`` tells them apart); an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volpanel.llm.common import release_memory, stored

LENGTH = 2048
END_ID = 0
GROUP_PIECES = 8_192
FALL = 0.8  # a round that leaves more than this part of its pieces underfull is the last
#: the tokenizer's rule for the pieces of a lower-case ASCII text
PIECE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
#: a piece of letters and a piece of closing marks, either may be missing
SIMPLE = re.compile(rb"([a-z]*)([.,!?*$#%&|;:]*)")
PLAIN = re.compile(rb"[a-z]+|[0-9]|[!-/:-@\[-`{-~]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Token ids of texts, piece by piece.

    The tokenizer drops white space and never joins characters across it, and cuts words into runs of
    letters, single digits and runs of other characters before it merges.  An ASCII text is lower-cased and cut into
    pieces by that rule here, and each distinct piece of a task is merged once, by the tokenizer's own merge model (a word is not
    looked up as a whole: most differ by their marks only); words of other texts are cut once each.
    """

    MOST = 450_000  # words held at once

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # texts that spell one of these are encoded whole, with the tokenizer's default
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.clear()

    def clear(self):
        self.words: dict[bytes, int] = {}  # word or piece -> its place in the arrays
        self.memo: dict[bytes, list[int]] = {}  # piece -> ids
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids_of(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct words; pieces of lower-case printable ASCII go to the merge model directly."""
        merge, memo = self.model.tokenize, self.memo
        out, hard = [], {}
        for w in words:
            if PLAIN.fullmatch(w):  # a piece of its own, as most words are
                if w not in memo:
                    memo[w] = tuple([t.id for t in merge(w.decode())])
                out.append((w,))
                continue
            m = SIMPLE.fullmatch(w)
            if m is None:
                pieces = self.parts(w)
            else:
                a, b = m.groups()
                pieces = (a, b) if a and b else (a or b,)
            for p in pieces:
                if p not in memo:
                    if m is not None or PLAIN.fullmatch(p):
                        memo[p] = tuple([t.id for t in merge(p.decode())])
                    else:
                        memo[p] = None
                        hard[p] = None
            out.append(pieces)
        if hard:
            todo = list(hard)
            for p, got in zip(todo, self.tokenizer.encode_batch_fast([p.decode() for p in todo], add_special_tokens=False)):
                memo[p] = tuple(got.ids)
        return [memo[p[0]] if len(p) == 1 else memo[p[0]] + memo[p[1]] if len(p) == 2 else tuple(chain.from_iterable(map(memo.__getitem__, p))) for p in out]

    def learn(self, words: set[bytes]):
        todo = list(words)
        lists = self.ids_of(todo)
        self.words.update(zip(todo, range(len(self.words), len(self.words) + len(todo))))
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])

    def __call__(self, texts: list):
        """uint32 ids of each text."""
        named = [k for k, t in enumerate(texts) if t and any(s in t for s in self.special)]
        if named:
            out = self([None if k in set(named) else t for k, t in enumerate(texts)])
            self.tokenizer.encode_special_tokens = False
            for k in named:
                out[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, np.uint32)
            self.tokenizer.encode_special_tokens = True
            return out
        split = [PIECE.findall(t.encode().lower()) if t.isascii() else t.encode().split() for t in (x or "" for x in texts)]
        words = list(chain.from_iterable(split))
        at = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            unknown = {words[i] for i in new}
            if len(self.words) + len(unknown) > self.MOST:
                self.clear()
                unknown, new = set(words), range(len(words))
            self.learn(unknown)
            at[new] = np.fromiter(map(self.words.__getitem__, map(words.__getitem__, new)), np.int64, len(new))
        n = self.sizes[at]
        ends = np.cumsum(n)
        ids = self.flat[np.repeat(self.starts[at] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        stops = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])]
        return [ids[a:b] for a, b in zip(stops[:-1], stops[1:])]

    @staticmethod
    def parts(w: bytes) -> list[bytes]:
        """Pieces of a word: an ASCII word by the rule, another as it is but for closing punctuation."""
        if w.isascii():
            return PIECE.findall(w.lower())
        if w[-1] in b".,!?":  # behind a letter, a run of its own
            body = w.rstrip(b".,!?")
            s = body.decode()
            if s.isalpha() and s.lower().isalpha():  # a letter may fall into a letter and a mark
                return [body, w[len(body) :]]
        return [w]


def pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, row_id, piece, start, length, ids_crc32: one row per piece.

    ``tokenizer`` is the vocabulary file as the workers see it; without it each worker asks its own installation."""

    def run(batches):
        import gc

        encoder = Encoder(tokenizer or default_tokenizer())
        gc.disable()  # the words' lists hold no cycles, but each collection would walk them all
        try:
            for b in batches:
                ids, rows, texts = (b.column(k).to_pylist() for k in range(3))
                for lo in range(0, len(texts), 500):
                    out = {k: [] for k in ("doc_id", "row_id", "piece", "start", "length", "ids_crc32")}
                    for doc, row, got in zip(ids[lo : lo + 500], rows[lo : lo + 500], encoder(texts[lo : lo + 500])):
                        got = np.append(got, np.uint32(END_ID)).astype("<u4")
                        for k, start in enumerate(range(0, len(got), length)):
                            part = got[start : start + length]
                            for name, v in zip(out, (doc, row, k, start, len(part), zlib.crc32(part.tobytes()))):
                                out[name].append(v)
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(out["doc_id"], b.schema.field(0).type), "row_id": pa.array(out["row_id"], pa.int64()), "piece": pa.array(out["piece"], pa.int32())} | {k: pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32")})
        finally:
            gc.enable()
        del encoder
        release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, row_id long, piece int, start long, length long, ids_crc32 long")


# ---- packing one group ---------------------------------------------------------------

def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of positions in ``sizes``."""
    bins: list[list[int]] = []
    free: dict[int, list[int]] = {}  # free room -> bins
    keys: list[int] = []  # sorted free rooms
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect.bisect_left(keys, sizes[i])
        if at == len(keys):
            bins.append([i])
            k, left = len(bins) - 1, room - sizes[i]
        else:
            gap = keys[at]
            k = free[gap].pop()
            if not free[gap]:
                del free[gap]
                keys.pop(at)
            bins[k].append(i)
            left = gap - sizes[i]
        if left:
            if left not in free:
                bisect.insort(keys, left)
                free[left] = []
            free[left].append(k)
    return bins


class Underfull:
    """Pieces and pairs of pieces of the underfull bins, flat, to look for steps in all bins at once."""

    def __init__(self, bins: list[list[int]], sizes: list[int], room: int):
        self.bins, self.sizes, self.room = bins, np.asarray(sizes, np.int64), room
        self.fill = np.array([self.sizes[b].sum() for b in bins], np.int64)
        self.pairs = [None] * len(bins)
        self.flat()

    def pairs_of(self, k: int):
        """(sum, first, second) of a bin's pairs, one for each pair of sizes."""
        if self.pairs[k] is None:
            own = np.array(self.bins[k], np.int64)
            s = self.sizes[own]
            _, first = np.unique(s, return_index=True)
            keep = np.zeros(len(own), bool)  # of equal pieces two are enough
            keep[first] = True
            rest = np.flatnonzero(~keep)
            _, second = np.unique(s[rest], return_index=True)
            keep[rest[second]] = True
            own = own[keep]
            i, j = np.triu_indices(len(own), 1)
            self.pairs[k] = (self.sizes[own[i]] + self.sizes[own[j]], own[i], own[j])
        return self.pairs[k]

    def flat(self):
        counts = [len(b) for b in self.bins]
        self.piece = np.array([i for b in self.bins for i in b], np.int64)
        self.piece_bin = np.repeat(np.arange(len(self.bins)), counts)
        got = [self.pairs_of(k) for k in range(len(self.bins))]
        self.pair_bin = np.repeat(np.arange(len(self.bins)), [len(g[0]) for g in got])
        self.pair_sum, self.pair_a, self.pair_b = (np.concatenate([g[c] for g in got]) if got else np.zeros(0, np.int64) for c in range(3))

    def best(self, b: int):
        """(gain, bin, given pieces, taken pieces) of the best step into bin b from a bin that is not fuller."""
        gap, fill = self.room - self.fill[b], self.fill[b]
        best = (0, None, (), ())
        if gap == 0 or not self.bins[b]:
            return best
        fits = (self.fill <= fill) & (self.fill > 0)
        fits[b] = False
        ones = np.flatnonzero(fits[self.piece_bin])
        twos = np.flatnonzero(fits[self.pair_bin])
        own = np.array(self.bins[b], np.int64)
        take_sum, take_a, take_b = self.pairs_of(b)
        # what may go to b, and what may come back for it: nothing, one piece, or two for one
        for give, many in ((ones, 1), (twos, 2)):
            if not len(give) or best[0] == gap:
                continue
            size = self.sizes[self.piece[give]] if many == 1 else self.pair_sum[give]
            order = np.argsort(size, kind="stable")
            give, size = give[order], size[order]
            nothing, one, two = (np.zeros(1, np.int64), [()]), (self.sizes[own], own[:, None]), (take_sum, np.stack([take_a, take_b], axis=1))
            for back, pieces_ in (nothing, one, two) if many == 1 else (one,):
                if not len(back):
                    continue
                at = np.searchsorted(size, back + gap, side="right") - 1  # the largest that leaves a gain of at most the gap
                gain = np.where(at >= 0, size[np.maximum(at, 0)] - back, 0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    g = give[at[k]]
                    given, a = ((int(self.piece[g]),), self.piece_bin[g]) if many == 1 else ((int(self.pair_a[g]), int(self.pair_b[g])), self.pair_bin[g])
                    best = (int(gain[k]), int(a), given, tuple(int(i) for i in pieces_[k]))
        return best

    def step(self, b: int, gain: int, a: int, given: tuple, taken: tuple):
        for i in given:
            self.bins[a].remove(i)
            self.bins[b].append(i)
        for i in taken:
            self.bins[b].remove(i)
            self.bins[a].append(i)
        self.fill[b] += gain
        self.fill[a] -= gain
        self.pairs[a] = self.pairs[b] = None
        self.flat()


def improve(bins: list[list[int]], sizes: list[int], room: int) -> list[list[int]]:
    """Moves and exchanges (one for one, two for one, one for two) between underfull bins until none raises the sum of squared fills.

    A step hands a bin b a net gain g of at most its free room, from a bin a that is not fuller: fill(b)**2 + fill(a)**2 rises,
    so the steps come to an end, and bins that reach zero are gone.  All underfull bins, pieces and pairs are looked at; the end
    is a local optimum of these steps."""
    done = [b for b in bins if sum(sizes[i] for i in b) == room]
    state = Underfull([list(b) for b in bins if sum(sizes[i] for i in b) < room], sizes, room)
    changed = True
    while changed:
        changed = False
        for b in np.argsort(-state.fill, kind="stable").tolist():
            while True:
                gain, a, given, taken = state.best(b)
                if not gain:
                    break
                state.step(b, gain, a, given, taken)
                changed = True
    return done + [b for b in state.bins if b]


def pack_group(sizes: list[int], room: int) -> list[list[int]]:
    bins = best_fit(sizes, room)
    return improve(bins, sizes, room)


# ---- packing all ---------------------------------------------------------------------

COLUMNS = "doc_id {kind}, row_id long, piece int, start long, length long, ids_crc32 long"


def packer(k: int, last: bool, length: int):
    """Packs one group of round ``k``."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("row_id", "ascending"), ("piece", "ascending")])
        sizes = t.column("length").to_pylist()
        b, o, full = np.zeros(len(sizes), np.int32), np.zeros(len(sizes), np.int64), np.zeros(len(sizes), bool)
        for at, own in enumerate(pack_group(sizes, length)):
            b[own] = at
            ends = np.cumsum([sizes[i] for i in own])
            o[own] = ends - np.array([sizes[i] for i in own])
            full[own] = last or ends[-1] == length
        g = t.column("_group")
        t = t.drop_columns(["_group"])
        return t.append_column("_round", pa.array(np.full(len(b), k, np.int32))).append_column("_group", g).append_column("_bin", pa.array(b)).append_column("offset", pa.array(o)).append_column("_full", pa.array(full))

    return run


def pack(cut: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``cut`` (of ``pieces``) with sequence_id and offset."""
    schema = COLUMNS.format(kind=cut.schema["doc_id"].dataType.simpleString()) + ", sequence_id long, offset long"
    cut = stored(cut, "pieces")
    alone = cut.where(F.col("length") >= length)
    parts = [alone.select("*", F.lit(-1).cast("int").alias("_round"), F.lit(0).cast("int").alias("_group"), F.lit(0).cast("int").alias("_bin"), F.lit(0).cast("long").alias("offset"))]
    rest, n = cut.where(F.col("length") < length), None
    inner = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", _round int, _group int, _bin int, offset long, _full boolean"
    for k in range(1 << 6):
        before, n = n, rest.count()
        groups = max(1, -(-n // group_pieces))
        last = groups == 1 or (before is not None and n > FALL * before) or k == (1 << 6) - 1

        dealt = rest.withColumn("_group", F.pmod(F.xxhash64("row_id", "piece", F.lit(k)), F.lit(groups)).cast("int"))
        done = stored(dealt.groupBy("_group").applyInArrow(packer(k, last, length), inner), f"packed-{k}")
        parts.append(done.where("_full").drop("_full"))
        if last:
            break
        rest = done.where("not _full").select(*cut.columns)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # bins are numbered by (round, group, bin); a piece that fills a sequence by itself gets a negative number
    number = F.when(F.col("_round") < 0, -1 - F.monotonically_increasing_id()).otherwise(
        F.col("_round").cast("long") * F.lit(1 << 57) + F.col("_group").cast("long") * F.lit(1 << 24) + F.col("_bin"))
    return out.select(*cut.columns, number.alias("sequence_id"), F.col("offset")).selectExpr(*[f"cast({f.split()[0]} as {f.split()[1]}) as {f.split()[0]}" for f in schema.split(", ")])
