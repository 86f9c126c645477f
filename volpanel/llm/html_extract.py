"""Main-text extraction: boosted trees over DOM nodes, decoded along the tree.

A page is parsed into block-level elements and text blocks (runs of text and inline elements).  Every
node, element or block, gets features of its subtree (text length, density of text per tag, link density,
punctuation), its attribute tokens and those above it, its depth and place, and its siblings.
Boosted trees (``gbdt``) give the log odds that the node holds main text.

Decoding is hierarchical: a node is kept only if its parent is, and the kept set is the one with the
largest sum of log odds under that rule (gain(n) = odds(n) + sum of the children's positive gains), so no block
is kept inside a dropped part, and no part is kept for nothing.  The text of kept blocks is returned.

The trees are fitted on ``PAGES`` generated pages (bounded, seeded) whose parts are known: articles in many
containers, with menus, headers, footers, sidebars, notices, adverts, forms, related links and
reader comments, with and without telling tags and classes, well-formed or not, some with hundreds of siblings.
Children of one parent are numbered once and open elements are found by tag, so no size or depth changes the method.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one space in page
order.  Scripts, styles, comments, titles, text areas and frames are never text; all other elements, such as formulas, controls,
drawings and fallback content, are nodes that the trees judge.

Defined cases: null or empty html, or html without a kept block, gives the empty text; broken markup is
parsed as far as it goes (open elements end with the page); repeated rows are extracted row by row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from volpanel.llm import gbdt

PAGES = 420
SEED = 5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
EMBEDDED = frozenset("noscript template svg object math select button audio video canvas".split())
FORMULA = "mi mn mo ms mrow mtext mspace mstyle mpadded mphantom menclose msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd semantics"
INLINE = frozenset(f"a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br img wbr input {FORMULA}".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SCOPE = frozenset("article aside blockquote body div footer form header html main nav section table td th ul ol dl".split())

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>""", re.S)
ATTR = re.compile(r"""(class|id|role|aria-label|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""\shidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

TAG_GROUPS = {
    "p": ["p"], "heading": ["h1", "h2", "h3", "h4", "h5", "h6"], "item": ["li", "dt", "dd"], "list": ["ul", "ol", "dl"], "box": ["div", "section", "center"],
    "article": ["article", "main"], "nav": ["nav", "menu"], "header": ["header", "hgroup"], "footer": ["footer", "address"], "aside": ["aside"], "form": ["form", "fieldset", "legend"],
    "table": ["table", "tbody", "thead", "tr", "td", "th"], "quote": ["blockquote", "pre"], "figure": ["figure", "figcaption"], "root": ["html", "body"],
    "control": ["button", "select", "option", "optgroup"], "formula": ["math"], "fallback": ["noscript", "object", "audio", "video", "canvas"], "drawing": ["svg", "template", "annotation"],
}
TAG_OF = {t: k for k, group in enumerate(TAG_GROUPS.values()) for t in group}
CUES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager tabs toc topbar skip sitemap".split(),
    "foot": "footer foot bottom copyright legal imprint colophon credits contentinfo".split(),
    "head": "header masthead head banner top logo branding brand".split(),
    "side": "sidebar side aside widget widgets rail column complementary left right".split(),
    "ad": "ad ads advert advertisement adv adsense sponsor sponsored promo promotion dfp sponsors commercial".split(),
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay warning disclaimer privacy message toast".split(),
    "comment": "comment comments reply replies discussion disqus respond commentlist feedback responses thread reader readers".split(),
    "social": "share sharing social follow twitter facebook tweet like subscribe newsletter signup rating".split(),
    "more": "related recommended recommend popular trending more teaser teasers similar also latest recent tags tag categories".split(),
    "form": "form search login register input contact poll survey quiz".split(),
    "main": "article content post entry main story body text page blog news document copy prose hentry".split(),
}
CUE_OF = {w: k for k, words in enumerate(CUES.values()) for w in words}
N_CUES, N_TAGS, MAIN = len(CUES), len(TAG_GROUPS), list(CUES).index("main")


class Node:
    __slots__ = ("tag", "parent", "kids", "depth", "cues", "hidden", "text", "links", "tags", "blocks", "size", "stops", "start", "words", "up", "label", "caps")

    def __init__(self, tag, parent, cues=(), hidden=False):
        self.tag, self.parent, self.kids = tag, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.cues, self.hidden = set(cues), hidden
        self.text, self.links, self.tags, self.blocks, self.size, self.stops, self.start, self.words, self.caps = None, 0, 1, 0, 0, 0, 0, 0, 0
        self.label = 0
        if parent:
            parent.kids.append(self)


def cues_of(attrs: str) -> list[int]:
    out = []
    for m in ATTR.finditer(attrs):
        for w in WORDS.findall(m[2]):
            if (k := CUE_OF.get(w.lower())) is not None:
                out.append(k)
    return out


MARK = "\ue000"  # generated pages mark main blocks with it


def parse(source: str) -> tuple[Node, list[Node]]:
    """(root, text blocks in page order)."""
    root = Node("html", None)
    stack, blocks = [root], []
    places: dict[str, list[int]] = {}  # tag -> places in the stack, so that no depth makes a search long
    scopes = [0]
    buffer: list[str] = []
    link_from, links, inline_cues, inline_tags = -1, 0, [], 0
    inlines: list[str] = []

    def add(piece: str):
        nonlocal links
        if piece:
            buffer.append(piece)
            if link_from >= 0:
                links += len(piece)

    def top(*tags):
        """Place of the innermost open element with one of these tags; 0: none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def cut(k):
        while len(stack) > k:
            tag = stack.pop().tag
            places[tag].pop()
            if tag in SCOPE:
                scopes.pop()

    def flush():
        nonlocal links, inline_cues, inline_tags
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                leaf = Node("#text", stack[-1], inline_cues)
                leaf.text, leaf.size, leaf.blocks = text, len(text), 1
                leaf.links, leaf.tags = min(links, len(text)), 1 + inline_tags
                leaf.words = text.count(" ") + 1
                leaf.stops = text.count(". ") + text.count("? ") + text.count("! ") + text.count(", ") + (text[-1] in ".?!")
                leaf.caps = text[0] in "©" or "©" in text[:40]
                blocks.append(leaf)
            buffer.clear()
        links, inline_cues, inline_tags = 0, [], 0

    at, n = 0, len(source)
    while at < n:
        m = TOKEN.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attrs = m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if tag in INLINE:
                if tag == "a":
                    link_from = -1
                continue
            k = top(tag)
            if k and (tag not in ("p", "li") or k > scopes[-1]):
                flush()
                cut(k)
            continue
        if tag in RAW:
            if attrs.endswith("/"):
                continue
            end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else n
            if tag not in ("script", "style", "title"):
                inline_tags += 1
            continue
        if attrs.endswith("/") and (tag in EMBEDDED or places.get("svg") or places.get("math")):
            continue  # a part of a drawing or formula, or an element, without content
        if tag == "head":
            continue
        if tag in INLINE:
            inline_tags += 1
            if tag == "br":
                add(" ")
            elif tag == "a":
                link_from = len(buffer)
            if "=" in attrs:
                inline_cues = [*inline_cues, *cues_of(attrs)]
            continue
        flush()
        link_from = -1
        if tag in CLOSES_P:
            inner = top("foreignobject")
            if out := [k for t in ("svg", "math", "select") for k in places.get(t, ()) if k > inner]:
                cut(min(out))  # these hold no such elements
            if (k := top("p")) > scopes[-1]:
                cut(k)
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
            same = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}[tag]
            if (k := top(*same)) > top("ul", "ol", "table", "dl", "select", *(() if tag == "tr" else ("tr",))):
                cut(k)
        if tag == "html" or tag == "body" and places.get("body"):
            continue
        if tag in VOID:
            continue
        unseen = tag in ("template", "annotation") or bool(attrs and HIDDEN.search(attrs))
        node = Node(tag, stack[-1], cues_of(attrs) if "=" in attrs else (), unseen)
        places.setdefault(tag, []).append(len(stack))
        if tag in SCOPE:
            scopes.append(len(stack))
        stack.append(node)
    flush()
    return root, blocks


# ---- features --------------------------------------------------------------------------

def walk(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(reversed(n.kids))
    return out


def feature_rows(root: Node) -> tuple[list[Node], np.ndarray]:
    nodes = walk(root)
    at = 0
    for n in nodes:  # text before the node; page order
        n.start = at
        at += n.size if n.text is not None else 0
    for n in reversed(nodes):
        if (p := n.parent) is not None:
            p.size += n.size
            p.links += n.links
            p.tags += n.tags
            p.blocks += n.blocks
            p.stops += n.stops
            p.words += n.words
    total = max(1, root.size)
    beside = {id(root): (0, 1, None, None)}  # place among the parent's children, those of the same tag, the one before, the one after
    for n in nodes:
        counts = Counter(k.tag for k in n.kids)
        for i, (k, before, after) in enumerate(zip(n.kids, [None, *n.kids], [*n.kids[1:], None])):
            beside[id(k)] = i, counts[k.tag], before, after
    out = np.zeros((len(nodes), 30 + N_TAGS + 2 * N_CUES), np.float32)
    up: dict[int, tuple] = {}
    for r, n in enumerate(nodes):
        p = n.parent
        above_tags, above_cues, hidden = up[id(p)] if p is not None else (0, 0, False)
        group = TAG_OF.get(n.tag, -1)
        own = 0
        for c in n.cues:
            own |= 1 << c
        hidden = hidden or n.hidden
        up[id(n)] = (above_tags | (1 << group if group >= 0 else 0), above_cues | own, hidden)
        kids = p.kids if p is not None else [n]
        i, same, before, after = beside[id(n)]
        size = n.size
        v = out[r]
        v[0] = n.text is not None
        v[1] = n.depth
        v[2] = math.log1p(size)
        v[3] = n.links / size if size else 0
        v[4] = math.log1p(n.words / n.blocks) if n.blocks else 0
        v[5] = math.log1p(n.blocks)
        v[6] = n.stops / n.words if n.words else 0
        v[7] = math.log1p(size / n.tags)
        v[8], v[9] = n.start / total, (n.start + size) / total
        v[10] = size / total
        v[11] = size / p.size if p is not None and p.size else 1
        v[12] = math.log1p(len(kids))
        v[13] = same / len(kids)
        v[14] = size * len(kids) / p.size if p is not None and p.size else 1
        v[15] = math.log1p(before.size) if before else -1
        v[16] = math.log1p(after.size) if after else -1
        v[17] = before.links / before.size if before and before.size else 0
        v[18] = after.links / after.size if after and after.size else 0
        v[19] = hidden
        v[20] = n.caps
        v[21] = math.log1p(total)
        v[22] = p.links / p.size if p is not None and p.size else 0
        v[23] = i / len(kids)
        for k, g in ((24, "nav header footer aside form"), (25, "article"), (26, "control"), (27, "formula"), (28, "fallback"), (29, "drawing")):
            v[k] = sum(above_tags >> list(TAG_GROUPS).index(x) & 1 for x in g.split())
        if group >= 0:
            v[30 + group] = 1
        elif p is not None and n.text is not None and (g := TAG_OF.get(p.tag, -1)) >= 0:
            v[30 + g] = 0.5  # a block tells its element's tag
        for c in n.cues:
            v[30 + N_TAGS + c] = 1
        for c in range(N_CUES):
            v[30 + N_TAGS + N_CUES + c] = above_cues >> c & 1
    return nodes, out


def decode(nodes: list[Node], odds: np.ndarray) -> list[str]:
    """Texts of the kept blocks: the best set in which every kept node's parent is kept."""
    gain = {}
    for n, s in zip(reversed(nodes), reversed(odds.tolist())):
        gain[id(n)] = s + sum(max(0.0, gain[id(k)]) for k in n.kids)
    out, kept = [], set()
    for n in nodes:
        if gain[id(n)] > 0 and (n.parent is None or id(n.parent) in kept):
            kept.add(id(n))
            if n.text is not None:
                out.append(n.text)
    return out


# ---- generated pages --------------------------------------------------------------------

class Maker:
    """Random pages; main blocks carry MARK."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.vocab = ["".join(self.r.choice("bcdfghklmnprstvw") + self.r.choice("aeiouéäö") for _ in range(self.r.randint(1, 4))) for _ in range(900)]

    def words(self, lo, hi):
        return [self.r.choice(self.vocab) for _ in range(self.r.randint(lo, hi))]

    def sentence(self, lo=3, hi=18):
        w = self.words(lo, hi)
        if len(w) > 8 and self.r.random() < 0.5:
            w[len(w) // 2] += ","
        if self.junk:
            w = [x + self.r.choice(["***", "###", "$$$", "%%%", "&amp;&amp;"]) for x in w]
        if self.shout:
            w = [x.upper() + "!!" for x in w]
        return " ".join(w).capitalize() + self.r.choice([".", ".", ".", "?", "!"])

    def prose(self, lo=1, hi=8):
        return " ".join(self.sentence() for _ in range(self.r.randint(lo, hi)))

    def link(self, text=None):
        return f'<a href="/{self.r.choice(self.vocab)}">{text or " ".join(self.words(1, 3))}</a>'

    def attr(self, names, p=0.8):
        if self.r.random() > p:
            return ""
        name = self.r.choice(names)
        name = self.r.choice([name, f"{self.r.choice(self.vocab)}-{name}", f"{name}-{self.r.choice(['box', 'area', 'wrap', 'inner', '2'])}"])
        return f' {self.r.choice(["class", "class", "id"])}="{name}"'

    def many(self, lo, hi):
        """A count; now and then one of a long page, up to hundreds."""
        return self.r.randint(lo, hi) if self.r.random() < 0.97 else self.r.randint(60, 400)

    def menu(self):
        items = [self.link() for _ in range(self.many(3, 12))]
        body = self.r.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " | ".join(items), "".join(f"<div>{x}</div>" for x in items)])
        return self.r.choice([f"<nav{self.attr(['menu', 'nav'], 0.4)}>{body}</nav>", f"<div{self.attr(['menu', 'navbar', 'navigation', 'breadcrumbs'], 0.9)}>{body}</div>"])

    def advert(self):
        text = self.r.choice([self.sentence(2, 9), self.prose(1, 3), self.link(self.sentence(2, 6))])
        return self.r.choice([f"<div{self.attr(['ad', 'ads', 'advert', 'sponsored', 'promo'], 1)}>{text}</div>", f"<aside{self.attr(['ad', 'promo'], 0.6)}>{text}</aside>", f"<div{self.attr(['ad', 'advertisement'], 1)}><p>{text}</p></div>"])

    def notice(self):
        text = self.r.choice(["We use cookies. ", "Please accept our terms. ", ""]) + self.prose(1, 3)
        return f"<div{self.attr(['cookie', 'consent', 'notice', 'alert', 'popup'], 1)}><p>{text}</p><button>OK</button></div>"

    def header(self):
        text = f"<a href='/'>{' '.join(self.words(1, 3))}</a>" + self.r.choice(["", f"<p>{self.sentence(2, 7)}</p>"])
        text += self.menu() if self.r.random() < 0.5 else ""
        return self.r.choice([f"<header>{text}</header>", f"<div{self.attr(['header', 'masthead', 'banner', 'top'], 1)}>{text}</div>"])

    def footer(self):
        text = self.r.choice([f"&copy; {self.r.choice(self.vocab)}.example &middot; {self.sentence(3, 14)}", f"<p>{self.prose(1, 2)}</p>", " ".join(self.link() for _ in range(5)) + f"<p>&copy; 2024 {self.sentence(2, 5)}</p>", self.prose(1, 2)])
        return self.r.choice([f"<footer>{text}</footer>", f"<footer{self.attr(['footer'], 0.5)}>{text}</footer>", f"<div{self.attr(['footer', 'bottom', 'copyright', 'legal'], 1)}>{text}</div>"])

    def sidebar(self):
        inner = f"<h3>{' '.join(self.words(1, 3))}</h3>" + self.r.choice([f"<p>{self.prose(1, 3)}</p>", "<ul>" + "".join(f"<li>{self.link(self.sentence(3, 8))}</li>" for _ in range(4)) + "</ul>"])
        return self.r.choice([f"<aside>{inner}</aside>", f"<aside{self.attr(['sidebar'], 0.7)}>{inner}</aside>", f"<div{self.attr(['sidebar', 'widget', 'related', 'side', 'popular'], 1)}>{inner}</div>"])

    def form(self):
        return f"<form{self.attr(['search', 'login', 'newsletter', 'contact'], 0.6)}>" + self.r.choice(["", f"<p>{self.sentence(3, 10)}</p>"]) + f"<label>{' '.join(self.words(1, 2))}</label><input name=q><button>Go</button></form>"

    def comments(self):
        one = lambda: self.r.choice([f"<div{self.attr(['comment', 'reply'], 0.9)}><b>{self.words(1, 1)[0]}</b><p>{self.prose(1, 4)}</p></div>", f"<li><span>{self.words(1, 1)[0]}</span> <p>{self.prose(1, 3)}</p></li>"])
        inner = self.r.choice(["", f"<h3>{self.r.randint(1, 40)} Comments</h3>"]) + "".join(one() for _ in range(self.many(1, 6)))
        return self.r.choice(["<section{}>{}</section>", "<div{}>{}</div>", "<ol{}>{}</ol>"]).format(self.attr(["comments", "commentlist", "discussion", "replies", "respond"], 1), inner)

    def embedded(self, open_=0.0):
        """An element around something that is no main text; a part of ``open_`` is never closed."""
        r = self.r
        tag, text = r.choice([
            ("button", " ".join(self.words(1, 3))),
            ("select", "".join(f"<option>{' '.join(self.words(1, 2))}</option>" for _ in range(r.randint(2, 8)))),
            ("svg", f"<title>x</title><path d='M0'/><text>{' '.join(self.words(1, 2))}</text>"),
            ("noscript", f"Please enable JavaScript. {self.sentence(2, 9)}"),
            ("template", f"<p>{self.prose(1, 2)}</p>"),
            (r.choice(["audio", "video", "canvas", "object"]), r.choice([f"Your browser does not support it. {self.sentence(2, 6)}", f"<p>{self.sentence(3, 8)}</p>"])),
        ])
        return f"<{tag}{self.attr(['search', 'menu', 'share'], 0.2)}>{text}" + (f"</{tag}>" if tag == "template" or r.random() >= open_ else "")

    def aside_text(self):
        """Main text in an element that often holds none."""
        r, m = self.r, MARK
        if r.random() < 0.5:
            formula = f"<math><mrow><mi>{m}{self.words(1, 1)[0]}</mi><mo>=</mo><mn>{r.randint(1, 99)}</mn></mrow></math>"
            return f"<p>{m}{self.sentence()} {formula} {m}{self.sentence()}</p>"
        tag = r.choice(["object", "noscript", "object"])
        return f"<{tag}><p>{m}{self.prose(2, 6)}</p></{tag}>"

    def share(self):
        return f"<div{self.attr(['share', 'social', 'follow'], 1)}>" + " ".join(self.link() for _ in range(3)) + "</div>"

    def main_part(self):
        r, m = self.r, MARK
        kind = r.random()
        if kind < 0.62:
            body = self.prose(1, 9)
            if r.random() < 0.25:
                body = body.replace(" ", " " + self.link() + " ", 1)
            if r.random() < 0.12:
                return f"<p><b>{m}{body}<br>" + ("" if r.random() < 0.7 else "</p>")
            return f"<p>{m}{body}" + ("</p>" if r.random() < 0.85 else "")
        if kind < 0.72:
            return f"<h{(k := r.randint(2, 4))}>{m}{' '.join(self.words(1, 8))}</h{k}>"
        if kind < 0.80:
            return "<ul>" + "".join(f"<li>{m}{r.choice([self.sentence(2, 12), ' '.join(self.words(1, 5))])}</li>" for _ in range(self.many(2, 6))) + "</ul>"
        if kind < 0.85:
            return f"<blockquote>{m}{self.prose(1, 3)}</blockquote>"
        if kind < 0.89:
            return f"<figure><img src=x><figcaption>{m}{self.sentence(3, 12)}</figcaption></figure>"
        if kind < 0.92:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{m}{' '.join(self.words(1, 3))}</td>" for _ in range(3)) + "</tr>" for _ in range(self.many(2, 4))) + "</table>"
        if kind < 0.95:
            return f"<pre>{m}{self.prose(1, 2)}</pre>"
        return f"<div>{m}{self.prose(1, 4)}</div>"

    def page(self) -> str:
        r = self.r
        self.junk, self.shout = r.random() < 0.12, r.random() < 0.06
        title = f"<h1>{MARK}{r.choice([self.sentence(1, 9), ' '.join(self.words(1, 8))])}</h1>"
        parts = [title] if r.random() < 0.85 else []
        parts += [self.main_part() for _ in range(r.choice([0, 1, 1, 2, 3, 4, 6, 9, 14] if r.random() < 0.95 else [30, 60, 120, 240]) + (0 if parts else 1))]
        if r.random() < 0.15:
            parts.insert(r.randint(0, len(parts)), self.aside_text())
        if r.random() < 0.25:
            parts.insert(r.randint(0, len(parts)), self.embedded())
        if r.random() < 0.25:
            parts.insert(r.randint(0, len(parts)), r.choice([self.advert, self.share, self.sidebar])())
        if r.random() < 0.15:
            parts.append(self.comments())
        inner = "".join(parts)
        wrap = r.random()
        if wrap < 0.40:
            main = f"<article{self.attr(['post', 'entry', 'story'], 0.3)}>{inner}</article>"
        elif wrap < 0.52:
            main = f"<main>{inner}</main>"
        elif wrap < 0.85:
            main = f"<div{self.attr(['content', 'article', 'post', 'entry', 'story', 'main', 'text'], 0.9)}>{inner}</div>"
        elif wrap < 0.93:
            main = f"<section>{inner}</section>"
        else:
            main = f"<table><tr><td>{inner}</td></tr></table>"
        if r.random() < 0.3:
            main = f"<div{self.attr(['wrapper', 'container', 'page', 'main', 'content'], 0.8)}>{main}{self.sidebar() if r.random() < 0.4 else ''}</div>"
        head = [f() for f, p in ((self.notice, 0.2), (self.header, 0.4), (self.menu, 0.7), (self.advert, 0.45), (self.form, 0.2), (self.sidebar, 0.2), (lambda: self.embedded(0.2), 0.25)) if r.random() < p]
        tail = [f() for f, p in ((self.share, 0.2), (self.comments, 0.3), (self.sidebar, 0.3), (self.advert, 0.2), (self.form, 0.15), (self.menu, 0.15), (self.footer, 0.8), (self.notice, 0.08), (lambda: self.embedded(0.2), 0.15)) if r.random() < p]
        if r.random() < 0.3:
            r.shuffle(head)
        end = "" if r.random() < 0.1 else "</body></html>"
        return "<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>" + "".join(head) + main + "".join(tail) + end


def generated(pages: int, seed: int):
    """(nodes, features, labels) of each generated page."""
    maker = Maker(seed)
    for _ in range(pages):
        root, blocks = parse(maker.page())
        marks = [MARK in b.text for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MARK, "")
            b.size = len(b.text)
        nodes, x = feature_rows(root)
        for b, m in zip(blocks, marks):
            b.label = int(m)
        for n in reversed(nodes):
            if n.label and n.parent is not None:
                n.parent.label = 1
        yield nodes, x, np.array([n.label for n in nodes], float)


def fit(pages: int = PAGES, seed: int = SEED) -> dict:
    xs, ys = zip(*((x, y) for _, x, y in generated(pages, seed)))
    return gbdt.fit(np.concatenate(xs).astype(float), np.concatenate(ys), trees=50, depth=5, rate=0.25, least=6)


def extract_batch(model: dict, sources: list) -> list[str]:
    trees, parts = [], []
    for s in sources:
        nodes, x = feature_rows(parse(s or "")[0])
        trees.append(nodes)
        parts.append(x)
    if not trees:
        return []
    odds = gbdt.predict(model, np.concatenate(parts))
    cuts = np.cumsum([len(t) for t in trees])[:-1]
    return [" ".join(decode(nodes, own)) for nodes, own in zip(trees, np.split(odds, cuts))]


def extract(pages: DataFrame, model: dict | None = None) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""
    model = model or fit()

    def run(batches):
        for b in batches:
            sources = b.column(2).to_pylist()
            for lo in range(0, len(sources), 256):
                texts = extract_batch(model, sources[lo : lo + 256])
                own = b.slice(lo, 256)
                yield pa.RecordBatch.from_pydict({"page_id": own.column(0), "url": own.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
