"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base spans are matches of fixed patterns per kind (leftmost, not overlapping), kept if they pass
the kind's check; they always stay.  High-recall generators propose more spans: written-out e-mail
addresses, numbers of a telephone's shape without a plus, card numbers in other separators, and
IPv6 addresses.  Boosted trees score each candidate by its format and its context; a sigmoid fitted on
held-out candidates calibrates the score, and a threshold per kind, the lowest whose held-out precision is at
least ``PRECISION``, selects the redactions.

The trees are fitted here on ``SAMPLES`` generated sentences (bounded, seeded) whose candidates get the same
DataFrame features, and compiled to CASE expressions; no Python runs on the executors.

Positions come from splitting the text at the matches: code points, ends exclusive.  The patterns are
written so that a failed start is not tried again inside the same run of characters, and groups repeat
possessively, so a text of any length is matched in linear time without recursion.

Defined cases: null or empty text has no span; repeated rows are reported row by row; other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volpanel.llm import gbdt

KINDS = ("email", "ip", "card", "phone")

LOCAL = r"[A-Za-z0-9._%+-]"
#: the base patterns, each anchored at the start of a run or at the end of the previous match
BASE = {
    "email": r"(?:\G|(?<!" + LOCAL + r"))" + LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: cheap conditions that a text with a base match meets
HINT = {"email": "@", "phone": "+"}
#: candidate generators of further spans
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:(?:\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9./_])[0-9]{4}(?:[./_][0-9]{4}){2}[./_][0-9]{1,7}(?![0-9./_])",
    "phone": r"(?<![0-9+.(-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20./-][0-9]{4}(?![0-9.-])",
}
MORE_HINT = {"email": r"(?:\(at\)|\[at\]|\x20at\x20)", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:", "card": r"[0-9]{4}[./_][0-9]{4}[./_]", "phone": r"[0-9]{3,4}[\x20./-][0-9]{4}"}
CONTEXT = 24
SAMPLES = 1600
PRECISION = 0.98


# ---- spans -------------------------------------------------------------------------

def find(text: Column, pattern: str) -> Column:
    """Array of (s, e, m): the matches of ``pattern`` with their code-point positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("p"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

    def add(acc, x):
        s = acc["at"] + x["p"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    return F.aggregate(pairs, start, add, lambda acc: acc["out"])


def empty_spans() -> Column:
    return F.array().cast("array<struct<s:int,e:int,m:string>>")


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def valid(kind: str, m: Column) -> Column:
    """The kind's check of a base match."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        d = digits(m)
        return F.length(d).between(13, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    hint = text.contains(HINT[kind]) if kind in HINT else text.rlike({"ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}"}[kind])
    return F.when(hint, F.filter(find(text, BASE[kind]), lambda x: valid(kind, x["m"]))).otherwise(empty_spans())


# ---- candidates and their features -----------------------------------------------------

CUES = {
    "person": r"(?:e-?mail|mail|contact|write|reach|kontakt|correo|courriel)",
    "call": r"(?:phone|tel|call|mobile|cell|fax|telefon|tél|móvil|dial)",
    "pay": r"(?:card|visa|master|amex|credit|debit|karte|tarjeta|carte|pay)",
    "host": r"(?:\bip\b|server|host|address|addr|ping|dns|gateway)",
    "other": r"(?:order|invoice|version|isbn|ref|sku|serial|part|case|page|date|ticket|build|item|no\.|nr\.|#|figure|meeting|score)",
}


def features(kind: str, text: Column, x: Column) -> list[Column]:
    """Numbers that describe a candidate: format, then context."""
    m, d = x["m"], digits(x["m"])
    first = F.greatest(x["s"] - CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, first + 1, x["s"] - first))
    after = F.substring(text, x["e"] + 1, F.lit(1))
    groups = F.split(F.regexp_replace(m, "[^0-9]+$|^[^0-9]+", ""), "[^0-9]+")
    flags = [
        F.lit(KINDS.index(kind)), F.length(m), F.length(d), F.size(groups),
        F.length(F.element_at(groups, 1)), F.length(F.element_at(groups, -1)),
        F.length(F.regexp_replace(m, r"[^\x20]", "")), F.length(F.regexp_replace(m, r"[^./_:-]", "")),
        m.startswith("("), (F.length(d) > 1) & F.coalesce(F.call_function("luhn_check", d), F.lit(False)),
        m.rlike(r"[(\[]at[)\]]"), m.rlike(r"(?:com|org|net|edu|de|fr|es|io)$"), m.rlike("[A-Fa-f]"),
        F.coalesce(F.length(F.array_max(F.transform(groups, lambda g: F.lpad(g, 12, "0")))), F.lit(0)), d.rlike(r"^(\d)\1+$"),
        *[before.rlike(CUES[c]) for c in CUES], after.rlike("[A-Za-z0-9]"), before.rlike(r"[A-Za-z0-9]$"),
    ]
    return [F.coalesce(f.cast("double"), F.lit(0.0)) for f in flags]


def candidates(text: Column, kind: str) -> Column:
    return F.when(text.rlike(MORE_HINT[kind]), find(text, MORE[kind])).otherwise(empty_spans())


def tree_score(model: dict, x: list[Column]) -> Column:
    """The boosted trees as nested CASE expressions."""
    def node(t):
        if isinstance(t, float):
            return F.lit(t)
        k, cut, left, right = t
        return F.when(x[k] <= cut, node(left)).otherwise(node(right))

    out = F.lit(model["base"])
    for t in model["trees"]:
        out = out + node(t)
    return out


# ---- fitting ---------------------------------------------------------------------------

def samples(n: int = SAMPLES, seed: int = 11) -> list[tuple[str, str, int, int]]:
    """(sentence, kind, span start, is personal) of generated sentences."""
    r = random.Random(seed)
    digit = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abdeghilmnorstu") for _ in range(r.randint(3, 8)))

    def luhn(k):
        body = str(r.randint(3, 6)) + digit(k - 2)
        total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(reversed(body)))
        return body + str(-total % 10)

    yes = {"email": ["e-mail", "mail me at", "contact", "reach me:", "correo", "write to"], "phone": ["phone", "call", "tel.", "mobile:", "fax", "telefon", "dial"], "card": ["card", "visa", "credit card", "paid with card", "tarjeta"], "ip": ["ip", "server", "host address", "ping"]}
    no = ["order", "invoice", "version", "isbn", "ref", "sku", "part no.", "case", "page", "date", "score", "build", "ticket", "meeting", word(), word(), word(), word()]
    out = []
    for _ in range(n):
        kind, good = r.choice(KINDS), r.random() < 0.5
        cue = r.choice(yes[kind]) if r.random() < (0.85 if good else 0.08) else r.choice(no)
        if kind == "email":
            at, dot = r.choice(["(at)", " (at) ", "[at]", " [at] ", " at "]) if good else " at ", r.choice(["(dot)", " [dot] ", " dot ", "."])
            span = word() + at + word() + dot + (r.choice(["com", "org", "net", "edu", "de", "fr", "es", "io"]) if good else word())
        elif kind == "phone":
            a, b, c = digit(3), "".join(digit(3)), digit(4)
            span = r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}"]) if good else r.choice([f"{digit(4)} {digit(4)} {digit(4)}", f"{digit(2)}/{digit(3)}/{c}", f"{a}/{b}/{c}", f"{digit(2)}.{digit(3)}.{c}", f"{a} {b} {c}"])
        elif kind == "card":
            s, sep = (luhn(16) if good else digit(16)), r.choice("./_")
            span = sep.join(s[i : i + 4] for i in range(0, 16, 4))
        else:
            span = ":".join(f"{r.randrange(1 << 16):x}" for _ in range(8)) if good else ":".join(digit(2) for _ in range(8))
        head = " ".join(word() for _ in range(r.randint(1, 6))) + f" {cue} "
        out.append((head + span + " " + " ".join(word() for _ in range(r.randint(1, 5))) + ".", kind, len(head), int(good)))
    return out


def fit(spark: SparkSession) -> dict:
    """{"trees": model, "calibration": (a, b), "cut": {kind: probability}} from generated candidates."""
    rows = spark.createDataFrame(samples(), "text string, kind string, at int, y int")
    parts = []
    for kind in KINDS:
        own = rows.where(F.col("kind") == kind).select("text", "at", "y", F.explode(candidates(F.col("text"), kind)).alias("x"))
        y = F.when((F.col("x.s") <= F.col("at")) & (F.col("x.e") > F.col("at")), F.col("y")).otherwise(0)
        parts.append(own.select(F.lit(kind).alias("kind"), "text", y.alias("y"), F.array(*features(kind, F.col("text"), F.col("x"))).alias("f")))
    got = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).orderBy("kind", "text").collect()
    x, y, kinds = np.array([r.f for r in got]), np.array([float(r.y) for r in got]), np.array([r.kind for r in got])
    held = np.arange(len(y)) % 3 == 0
    model = gbdt.fit(x[~held], y[~held], trees=24, depth=3)
    score = gbdt.predict(model, x[held])
    a, b = gbdt.calibrate(score, y[held])
    p = 1 / (1 + np.exp(-(a * score + b)))
    cut = {}
    for kind in KINDS:
        own = kinds[held] == kind
        order = np.argsort(-p[own], kind="stable")
        precise = np.cumsum(y[held][own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(precise >= PRECISION)
        cut[kind] = max(0.5, float(p[own][order][good[-1]])) if len(good) else 2.0
    return {"trees": model, "calibration": (a, b), "cut": cut}


# ---- all spans of a text ---------------------------------------------------------------

def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(F.lit(KINDS.index(kind)).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind")))


def report(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, counts of base spans per kind, base_sha256, spans (base and added), n_added."""
    model = model or fit(docs.sparkSession)
    a, b = model["calibration"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    base = rows.select("doc_id", "text", *[base_spans(text, k).alias(k) for k in KINDS])
    more = base.select("doc_id", "text", *KINDS, *[candidates(text, k).alias(f"{k}_more") for k in KINDS])

    def scored(kind):
        def one(x):
            z = tree_score(model["trees"], features(kind, text, x)) * a + b
            return F.struct((F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("p"), F.lit(KINDS.index(kind)).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"))

        picked = F.filter(F.transform(F.col(f"{kind}_more"), one), lambda x: x["p"] >= model["cut"][kind])
        return F.when(F.size(f"{kind}_more") > 0, picked).otherwise(F.array().cast("array<struct<p:double,k:int,s:int,e:int,kind:string>>"))

    kept = F.concat(*[tagged(F.col(k), k) for k in KINDS])
    wide = more.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], kept.alias("base"), F.concat(*[scored(k) for k in KINDS]).alias("picked"))
    # the likeliest first; a span joins if it overlaps none that stays
    order = F.array_sort(F.col("picked"), lambda x, y: F.when(x["p"] > y["p"], -1).when(x["p"] < y["p"], 1).when(x["s"] < y["s"], -1).when(x["s"] > y["s"], 1).otherwise(0))
    spans = F.aggregate(order, F.col("base"), lambda acc, x: F.when(
        F.exists(acc, lambda o: (o["s"] < x["e"]) & (x["s"] < o["e"])), acc).otherwise(F.concat(acc, F.array(F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))))
    done = wide.select("doc_id", *[f"n_{k}" for k in KINDS], "base", F.array_sort(spans).alias("spans"))
    return done.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))
