"""Plain versions of the corpus operators for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def fingerprint(text: str | None, n: int = 3) -> int:
    words = WORD.findall(lower(text or ""))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def components(rows: dict[int, int], radius: int = 3) -> dict[int, int]:
    ids = sorted(rows)
    fp = np.array([rows[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {ids[i]: ids[find(i)] for i in range(len(ids))}


def line_dedup(rows: list[tuple], min_docs: int = 3, min_chars: int = 20) -> dict:
    blank = " \t\n\x0b\x0c\r"
    holders: dict[str, set] = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = lower(line.strip(blank))
            if len(k) >= min_chars and doc is not None:
                holders.setdefault(k, set()).add(doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (doc is not None and len(k := lower(x.strip(blank))) >= min_chars and len(holders[k]) >= min_docs and max(holders[k]) != doc)]
        out[doc] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def contained(docs: list[tuple], items: list[tuple], n: int = 5) -> set:
    def grams(words, k):
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}

    out = set()
    for item, text in items:
        words = WORD.findall(lower(text or ""))
        if not words:
            continue
        k = min(n, len(words))
        own = grams(words, k)
        for doc, body in docs:
            both = len(own & grams(WORD.findall(lower(body or "")), k))
            if both * 5 >= len(own) * 4:
                out.add((doc, item, len(own), both))
    return out


def pieces(rows: list[tuple], tokenizer, length: int = 2048) -> set:
    out = set()
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), length)):
            part = np.array(ids[start : start + length], "<u4")
            out.add((doc, k, start, len(part), zlib.crc32(part.tobytes())))
    return out


def substring_dedup(rows: list[tuple], window: int = 20) -> dict:
    seen: dict[tuple, tuple] = {}
    docs = sorted(((d, (t or "").encode().split()) for d, t in rows), key=lambda x: x[0])
    for d, words in docs:
        for i in range(len(words) - window + 1):
            seen.setdefault(tuple(words[i : i + window]), (d, i))
    out = {}
    for d, words in docs:
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] < (d, i):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[d] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def pii_base(text: str | None) -> list[tuple]:
    """Base spans (kind, start, end), by Python's engine and the plain patterns."""
    text = text or ""

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m[0])]
