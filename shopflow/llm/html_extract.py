"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is read into leaf blocks: runs of text between block-level tags, each with what its ancestors' tags, classes and
ids say, and with text features.  The field labels the blocks as main text or not; its edge weights depend on whether
two blocks share their parent.  It is trained by gradient ascent (forward-backward over all pages at once) on labelled
pages, and pages are decoded by Viterbi.  Labelled pages are HTML whose elements carry data-main="1" or "0", the innermost
one counts; labelled_pages() writes varied ones by rule, and a caller may pass more.

Reading is linear in the page; an element's ancestors are kept as a set of a bounded number of features, so depth costs
nothing.  Scale: one pass over the pages without a shuffle; the model is a few hundred numbers.

Defined cases.  Null or empty html, and pages without text, give an empty string.  Scripts, styles, templates, the head
and comments are never text.  The head ends at its end tag, at text, or at a start tag that can't stand in it.  Unclosed and misnested tags close with their parent; a tag cut off at the end is dropped.
Character references are decoded once; white space inside a block becomes one space; <br> is white space.  Blocks are
joined by two line feeds.  Pages are read one by one, so ties, repeated rows and other columns don't matter.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template|noscript|svg|iframe|object|title)\b(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>|<(?P<end2>/?)(?P<tag2>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs2>[^<>]*+)>"
    r"|<[!?][^<>]*+>|<[A-Za-z/!?][^<>]*+\Z", re.DOTALL | re.IGNORECASE)
ATTR = re.compile(r"""([A-Za-z_:][-A-Za-z0-9_:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML: elements that break a line of text, have no end tag, or end an open one of the same group.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "head header hgroup hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base link meta noscript script style template title".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TAGS = ("article main section p li nav header footer aside form table blockquote pre figure figcaption h1 h2 h3 a button label div ul b td dl").split()
#: Words of classes, ids and roles, by what they say of an element.
HINTS = {
    "text": "article content post entry story text body main read prose",
    "menu": "nav navigation menu menubar breadcrumb breadcrumbs tabs toolbar pagination pager skip",
    "head": "header head masthead logo topbar top branding",
    "foot": "footer foot copyright legal bottom colophon contentinfo",
    "side": "sidebar side aside widget related recommended recommend more complementary trending popular links",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner adbox",
    "reader": "comment comments reply replies discussion discuss disqus respond response thread reader feedback",
    "notice": "cookie cookies consent notice notification alert popup modal overlay gdpr warning dialog message",
    "sign": "subscribe newsletter signup login register form search",
    "share": "share sharing social follow tweet",
    "credit": "byline author date meta tags tag category timestamp",
}
HINT_OF = {w: f"hint:{k}" for k, words in HINTS.items() for w in words.split()}
PHRASES = {
    "rights": re.compile(r"©|\(c\)|copyright|all rights reserved", re.IGNORECASE),
    "cookies": re.compile(r"cookie|consent|privacy|terms of", re.IGNORECASE),
    "sign": re.compile(r"subscribe|newsletter|sign up|log ?in|register|e-?mail", re.IGNORECASE),
    "advert": re.compile(r"advert|sponsored|promo", re.IGNORECASE),
    "reader": re.compile(r"\b(?:comment|reply|replies|posted by|wrote)", re.IGNORECASE),
    "share": re.compile(r"\bshare|follow us|tweet", re.IGNORECASE),
}
SHAPE = ["bias", "words<3", "words<6", "words<12", "words<30", "words>=30", "links0", "links<.4", "links<.8", "links>=.8", "ends", "marks", "first", "early", "late",
         "last", "digits", "bars", "h", "short no link", "long no link"]
FEATURES = {name: i for i, name in enumerate(SHAPE + [f"tag:{t}" for t in TAGS] + [f"hint:{k}" for k in HINTS] + [f"says:{k}" for k in PHRASES])}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class Block:
    __slots__ = ("text", "linked", "marks", "parent", "main")

    def __init__(self, text: str, linked: int, marks: frozenset, parent: int, main: int):
        self.text, self.linked, self.marks, self.parent, self.main = text, linked, marks, parent, main


def _own(tag: str, attrs: str) -> tuple[frozenset, int | None]:
    """What a tag says by itself, and its label if it has one."""
    marks, main = set(), None
    if f"tag:{tag}" in FEATURES:
        marks.add(f"tag:{tag}")
    if tag in HEADINGS:
        marks.add("h")
    if attrs and "=" in attrs:
        for m in ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id", "role"):
                marks.update(HINT_OF[w] for x in NAME.findall(value) if (w := x.lower()) in HINT_OF)
            elif name == "data-main":
                main = int(value == "1")
    return frozenset(marks), main


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    stack = [("", frozenset(), 0, 0)]  # tag, what it and its ancestors say, number of the nearest block element, label
    places: dict[str, list[int]] = {}  # where the open elements of each tag are in the stack, and those of all block tags
    block_places: list[int] = []
    parts: list[tuple[str, bool]] = []
    owner, n_elements, hidden = stack[0], 0, 0

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(p) for p, link in parts if link)
                total = max(1, sum(len(p.strip()) for p, _ in parts))
                out.append(Block(text, min(100, 100 * linked // total), owner[1], owner[2], owner[3]))
            parts.clear()

    def close(at: int) -> None:
        nonlocal hidden
        for tag, *_ in stack[at:]:
            places[tag].pop()
            hidden -= tag == "head"
        while block_places and block_places[-1] >= at:
            block_places.pop()
        del stack[at:]

    def add(text: str) -> None:
        nonlocal owner
        if hidden and stack[-1][0] == "head" and text.strip():
            close(places["head"][0])  # its end tag may be left out: text ends it
        if not hidden:
            if not parts:
                owner = stack[-1]
            parts.append((text, "tag:a" in stack[-1][1]))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if hidden and tag not in HEAD and not (m["end"] or m["end2"]):
            close(places["head"][0])  # so does what can't stand in it
        if tag == "br":
            parts.append((" ", False))
            continue
        block = tag in BLOCK
        if block:
            flush()
        if m["end"] or m["end2"]:
            if places.get(tag):  # an end tag without a start closes nothing
                close(places[tag][-1])
            continue
        if block:  # what this start tag ends
            ends = ENDS.get(tag, ())
            for n in range(len(block_places) - 1, -1, -1):
                i = block_places[n]
                if stack[i][0] == "p" or stack[i][0] in ends:
                    close(i)
                    if not ends:
                        break
                elif not (ends and stack[i][0] in ("tbody", "thead")):
                    break
        if tag in VOID:
            continue
        own, main = _own(tag, m["attrs"] or m["attrs2"] or "")
        n_elements += block
        up = stack[-1]
        places.setdefault(tag, []).append(len(stack))
        if block:
            block_places.append(len(stack))
        stack.append((tag, up[1] | own if own - up[1] else up[1], n_elements if block else up[2], up[3] if main is None else main))
        hidden += tag == "head"
    if at < len(page):
        add(page[at:])
    flush()
    return out


def features(blocks: list[Block]) -> list[list[int]]:
    """The features that hold, for each block."""
    out, n = [], len(blocks)
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        on = ["bias", "words<3" if words < 3 else "words<6" if words < 6 else "words<12" if words < 12 else "words<30" if words < 30 else "words>=30",
              "links0" if not b.linked else "links<.4" if b.linked < 40 else "links<.8" if b.linked < 80 else "links>=.8"]
        on += ["ends"] * (b.text[-1] in ".!?…\"”»") + ["marks"] * (b.text.count(",") + b.text.count(". ") >= 2) + ["first"] * (i == 0) + ["last"] * (i == n - 1)
        on += ["early"] * (10 * i < n) + ["late"] * (10 * i >= 9 * n) + ["bars"] * (b.text.count("|") + b.text.count("·") + b.text.count("»") > 0)
        on += ["short no link"] * (words < 6 and not b.linked) + ["long no link"] * (words >= 12 and not b.linked)
        if sum(map(str.isdigit, b.text)) * 5 > len(b.text):
            on.append("digits")
        on += b.marks
        on += [f"says:{k}" for k, rx in PHRASES.items() if rx.search(b.text)] if words < 60 else []
        out.append([FEATURES[f] for f in on])
    return out


class Field:
    """Weights: node (feature, label), edge (two blocks of one parent or not, label, label)."""

    def __init__(self):
        self.node, self.edge = np.zeros((len(FEATURES), 2)), np.zeros((2, 2, 2))

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best labels, by Viterbi."""
        if not blocks:
            return []
        scores = [self.node[f].sum(axis=0).tolist() for f in features(blocks)]
        edge = self.edge.tolist()
        best, back = scores[0], []
        for i in range(1, len(blocks)):
            e = edge[blocks[i].parent == blocks[i - 1].parent]
            step = [(best[0] + e[0][y], best[1] + e[1][y]) for y in (0, 1)]
            back.append([int(s[1] > s[0]) for s in step])
            best = [max(step[y]) + scores[i][y] for y in (0, 1)]
        y = int(best[1] > best[0])
        path = [y]
        for b in reversed(back):
            y = b[y]
            path.append(y)
        return path[::-1]

    def text(self, page: str | None) -> str:
        blocks = blocks_of(page or "")
        return "\n\n".join(b.text for b, y in zip(blocks, self.decode(blocks), strict=True) if y)


def fit(pages: list[str], steps: int = 150, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """Maximise the labels' likelihood by Adam, all pages side by side."""
    field = Field()
    read = [b for b in map(blocks_of, pages) if b]
    if not read:
        return field
    n, length = len(read), max(map(len, read))
    x = np.zeros((n, length, len(FEATURES)), np.float32)
    y, same, real = np.zeros((n, length), int), np.zeros((n, length), int), np.zeros((n, length), bool)
    for i, blocks in enumerate(read):
        for t, f in enumerate(features(blocks)):
            np.add.at(x[i, t], f, 1)
        y[i, :len(blocks)] = [b.main for b in blocks]
        same[i, 1:len(blocks)] = [a.parent == b.parent for a, b in zip(blocks, blocks[1:], strict=False)]
        real[i, :len(blocks)] = True
    lse = lambda v, axis: (m := v.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(v - m).sum(axis=axis))
    rows, total = np.arange(n), real.sum()
    first, second = [np.zeros_like(field.node), np.zeros_like(field.edge)], [np.zeros_like(field.node), np.zeros_like(field.edge)]
    for step in range(1, steps + 1):
        node = x @ field.node
        a, b = np.zeros((n, length, 2)), np.zeros((n, length, 2))
        a[:, 0] = node[:, 0]
        for t in range(1, length):
            new = lse(a[:, t - 1, :, None] + field.edge[same[:, t]], 1) + node[:, t]
            a[:, t] = np.where(real[:, t, None], new, a[:, t - 1])
        whole = lse(a[:, -1], 1)
        for t in range(length - 2, -1, -1):
            new = lse(field.edge[same[:, t + 1]] + (node[:, t + 1] + b[:, t + 1])[:, None, :], 2)
            b[:, t] = np.where(real[:, t + 1, None], new, b[:, t + 1])
        p = np.exp(a + b - whole[:, None, None])
        want = np.eye(2)[y]
        g_node = np.einsum("ntf,nty->fy", x, (want - p) * real[..., None]) / total - decay * field.node
        g_edge = -decay * field.edge
        for t in range(1, length):
            pair = np.exp(a[:, t - 1, :, None] + field.edge[same[:, t]] + (node[:, t] + b[:, t])[:, None, :] - whole[:, None, None])
            pair = -pair
            pair[rows, y[:, t - 1], y[:, t]] += 1
            np.add.at(g_edge, same[:, t], np.where(real[:, t, None, None], pair, 0) / total)
        for k, (w, g) in enumerate(((field.node, g_node), (field.edge, g_edge))):
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w += rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return field


def labelled_pages(n: int = 400, seed: int = 3) -> list[str]:
    """Labelled pages written by rule: many layouts, with and without telling names, some misnested."""
    rng = np.random.default_rng(seed)
    pick = lambda *options: options[int(rng.integers(0, len(options)))]
    chance = lambda p: rng.random() < p
    letters = "etaoinshrdlucmfwypvbgk"
    word = lambda: "".join(letters[i] for i in np.minimum(rng.geometric(0.12, int(rng.integers(1, 10))) - 1, len(letters) - 1))

    def words(lo: int, hi: int) -> str:
        return " ".join(word() for _ in range(int(rng.integers(lo, hi + 1))))

    def prose(sentences: int) -> str:
        return " ".join(words(2, 6).capitalize() + pick(", ", " ", " ") + words(1, 14) + pick(".", ".", ".", "?", "") for _ in range(sentences))

    def links(k: int, wrap: str = "li") -> str:
        return "".join(f'<{wrap}><a href="/{word()}">{words(1, 3)}</a></{wrap}>' for _ in range(k))

    def paragraphs(k: int) -> str:
        out = []
        for _ in range(k):
            t = prose(int(rng.integers(1, 7)))
            out.append(pick(f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}<br>", f"<p>{words(3, 8)} <a href='/x'>{words(1, 3)}</a> {t}</p>", f"<h2>{words(1, 6)}</h2><p>{t}</p>",
                            f"<blockquote>{t}</blockquote>", f"<ul><li>{words(2, 12)}</li><li>{words(2, 12)}</li></ul>", f"<figure><figcaption>{words(3, 9)}</figcaption></figure>",
                            f"<pre>{words(4, 20)}</pre>", f"<p>{words(1, 5)}.</p>", f"<h3>{words(1, 4)}</h3><p>{t}</p>", f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>"))
        return "".join(out)

    def reader() -> str:
        box = pick('section class="comments"', 'div id="comments"', 'div class="discussion"', 'ul class="replies"', 'section id="respond"')
        kind = box.split(" ")[0]
        item = "li" if kind == "ul" else "div"
        return f"<{box} data-main='0'><h3>{pick('Comments', 'Replies', words(1, 2))}</h3>" + "".join(
            f'<{item} class="{pick("comment", "reply", "post")}"><b>{word()}</b><p>{prose(int(rng.integers(1, 4)))}</p></{item}>' for _ in range(int(rng.integers(1, 6)))) + f"</{kind}>"

    def side() -> str:
        box = pick("aside", 'div class="sidebar"', 'div id="side"', 'div class="widget related"', 'aside class="related"')
        return f"<{box} data-main='0'><h3>{words(1, 3)}</h3>" + pick(f"<ul>{links(int(rng.integers(2, 7)))}</ul>", f"<p>{prose(2)}</p>", f"<p>{words(3, 10)}</p><ul>{links(3)}</ul>") + f"</{box.split(' ')[0]}>"

    def advert() -> str:
        return pick(f'<div class="{pick("ad", "ads", "advert", "sponsored", "promo banner")}" data-main="0">{pick(words(2, 9), prose(1), prose(2))}</div>',
                    f'<aside class="{pick("ad", "promo")}" data-main="0"><p>{prose(1)}</p></aside>', f"<div data-main='0'><a href='/x'>{words(2, 8)}</a></div>")

    def notice() -> str:
        return pick(f'<div class="{pick("cookie-notice", "notice", "consent", "alert", "popup")}" data-main="0"><p>{pick("We use cookies. ", "", "By reading on you consent. ")}{prose(1)}</p><button>OK</button></div>',
                    f'<div role="{pick("alert", "dialog")}" data-main="0">{prose(1)}</div>')

    def form() -> str:
        return f'<form {pick("", "class=newsletter ", "class=search ")}data-main="0"><label>{pick("E-mail", words(1, 3))}</label><p>{pick("Subscribe to our newsletter", words(2, 8))}</p><select><option>{word()}<option>{word()}</select><button>{word()}</button></form>'

    def share() -> str:
        return f'<div class="{pick("share", "social")}" data-main="0"><a href="/s">{pick("Share", word())}</a> <a href="/t">{word()}</a></div>'

    out = []
    for _ in range(n):
        title = words(2, 10)
        box = pick("article", "article", "article", "main", 'div class="post-content"', 'div id="content"', 'div class="entry"', "div", 'section class="story"')
        inside = [paragraphs(int(rng.integers(1, 9)))]
        if chance(0.3):
            inside.insert(int(rng.integers(0, 2)), pick(advert, side, share)())
            inside.append(paragraphs(int(rng.integers(1, 4))))
        if chance(0.15):
            inside.append(pick(reader, form)())
        heading = pick(f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", "")
        body = f"<{box} data-main='1'>{heading}{''.join(inside)}</{box.split(' ')[0]}>"
        before = [pick(f"<nav data-main='0'><ul>{links(int(rng.integers(2, 9)))}</ul></nav>", f"<div class='{pick('menu', 'navbar', 'top')}' data-main='0'>{links(int(rng.integers(2, 7)), 'span')}</div>", "",
                       f"<ul data-main='0'>{links(int(rng.integers(3, 8)))}</ul>")]
        before += [f"<header data-main='0'><div class='logo'>{words(1, 3)}</div><p>{words(2, 9)}</p></header>"] * chance(0.4)
        after = []
        for make, p in ((advert, 0.5), (notice, 0.35), (side, 0.35), (form, 0.25), (share, 0.2), (reader, 0.35)):
            if chance(p):
                (before if chance(0.4) and make is not reader else after).append(make())
        foot = pick(f"&copy; {words(1, 3)} &middot; {words(3, 12)}", f"&copy; {word()}. All rights reserved.", prose(1), f"<ul>{links(3)}</ul>", f"<p>{words(2, 8)}</p><p>{prose(1)}</p>")
        after.append(pick(f"<footer data-main='0'>{foot}</footer>", f"<footer data-main='0'>{foot}</footer>", f"<div class='{pick('footer', 'bottom legal')}' data-main='0'>{foot}</div>", ""))
        out.append(f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{title}</title><style>p{{margin:0}}</style></head><body>{''.join(before)}{body}{''.join(after)}</body></html>")
    return out


def main_text(html: Column, field: Field) -> Column:
    def run(col: pa.Array) -> pa.Array:
        return pa.array([field.text(p) for p in col.to_pylist()], pa.string())
    return F.arrow_udf(run, "string")(html)


def trained(more: list[str] = ()) -> Field:
    """The field, trained on the pages written by rule and any further labelled ones."""
    return fit(labelled_pages() + list(more))
