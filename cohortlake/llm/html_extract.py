"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

A page is cut into blocks, maximal runs of text between block-level tags. Each block is described by
its ancestor tags, the words in their class, id and role attributes, and its text. The field has two
states, main text and the rest; it is trained on labelled pages by gradient ascent on the conditional
likelihood (forward-backward), and decoded by Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import small_batches

# Element names of HTML by their role here.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Read as plain characters up to their end tag; without one, the two of code swallow the rest, the others nothing.
CODE = frozenset(["script", "style"])
RAW = CODE | frozenset("textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK - {"button", "option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html", "legend"}
MARKUP = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
#: A tag without odd quotes; it never looks past the next angle bracket.
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^'\"<>]*+(?:(?<==)(?:\"[^\"<>]*+\"|'[^'<>]*+')(?=[\s/>])[^'\"<>]*+)*+)>")
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
STOPS = re.compile("[>\"']")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SECTIONS = frozenset("article main nav aside footer header form section".split())
#: Contexts, and attribute texts, remembered at once; results don't depend on it.
KEPT = 20_000
LETTERS = re.compile(r"[a-z]+")

#: Labelled pages to train on, passes over them, step, and the weight of the squared penalty.
PAGES, EPOCHS, STEP, PENALTY = 900, 120, 0.15, 2e-4


class Context:
    """What is known of the ancestors of a block: one object for all blocks of the same description, at any depth."""

    __slots__ = ("names", "tag", "named", "section", "steps", "score")

    def __init__(self, names: frozenset, tag: str, named: tuple, section: str):
        self.names, self.tag, self.named, self.section = names, tag, named, section
        self.steps: dict[tuple, Context] = {}
        self.score = None


class Contexts:
    """All contexts met so far, told apart by their features. With `known` features, others leave no trace."""

    def __init__(self, known: set[str] | None = None):
        self.known, self.all, self.attributes = known, {}, {}
        self.root = Context(frozenset(["bias"]), "", (), "")

    def below(self, c: Context, tag: str, words: tuple, hidden: bool) -> Context:
        """The context of an element inside `c`."""
        key = (tag, words, hidden)
        got = c.steps.get(key)
        if got is None:
            new = {f"a:{tag}", *(f"c:{w}" for w in words), *(["hidden"] if hidden else [])}
            new = (new if self.known is None else new & self.known) - c.names
            known = self.known is None or f"p:{tag}" in self.known
            what = (c.names | new if new else c.names, tag if known else "", words or c.named, tag if tag in SECTIONS else c.section)
            got = c.steps[key] = self.all.setdefault(what, Context(*what))
        return got

    def described(self, rest: str) -> tuple[tuple, bool]:
        """Words of the naming attributes, and whether the element is hidden."""
        got = self.attributes.get(rest)
        if got is None:
            words = {w for g in NAMED.findall(rest) for w in LETTERS.findall("".join(g).lower())}
            if self.known is not None:
                words = {w for w in words if f"c:{w}" in self.known or f"i:{w}" in self.known}
            got = (tuple(sorted(words)), HIDDEN.search(rest) is not None)
            if len(rest) < 1000:
                self.attributes[rest] = got
        return got

    def trim(self) -> None:
        """Between pages: forget all if there is too much."""
        if len(self.all) > KEPT or len(self.attributes) > KEPT or len(self.root.steps) > KEPT:
            self.__init__(self.known)


class Block:
    __slots__ = ("context", "text", "linked")

    def __init__(self, context: Context, text: str, linked: int):
        self.context, self.text, self.linked = context, text, linked


class _Ends:
    """Where tags end. A quoted value may hold angle brackets. One that is never closed, or whose closing quote
    belongs to a later tag, ends its tag at the next `>`. Each character is looked at a fixed number of times."""

    def __init__(self, page: str):
        self.page, self.last, self.quotes, self.plain = page, page.rfind(">"), {q: page.rfind(q) for q in "\"'"}, False

    def find(self, start: int) -> int:
        """The place of the `>` of a tag that starts at `start`, which lies before some `>`."""
        page, at = self.page, start
        while not self.plain:
            m = STOPS.search(page, at)
            if m is None:
                # No end outside of quotes up to the page's end: from here on quotes mean nothing.
                self.plain = True
                break
            at, c = m.end(), m.group()
            if c == ">":
                return m.start()
            k = m.start() - 1
            while page[k].isspace():
                k -= 1
            if page[k] != "=":
                continue
            close = page.find(c, at) if self.quotes[c] >= at else -1
            inner = page.find(">", at, close if close >= 0 else None)
            if close < 0 or (inner >= 0 and close + 1 < len(page) and not (page[close + 1].isspace() or page[close + 1] in "/>")):
                if inner < 0:
                    break
                return inner
            at = close + 1
        return page.find(">", start)


def blocks(page: str, contexts: Contexts) -> list[Block]:
    """The page's text blocks in order, white space normalised; character references are decoded.

    The time grows with the page's length, whatever is left open, unbalanced or deeply nested.
    """
    out: list[Block] = []
    tags: list[str] = []
    path = [contexts.root]
    fences: list[int] = []  # for each open element the place of the innermost p or block element up to it
    opened: dict[str, int] = {}
    parts: list[str] = []
    linked = 0
    at, size, ends = 0, len(page), _Ends(page)
    endless: set[str] = set()

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(path[-1], text, linked))
            parts.clear()
        linked = 0

    def leave(k: int) -> None:
        """Close the open elements from the k-th on."""
        for t in tags[k:]:
            opened[t] -= 1
        del tags[k:], path[k + 1 :], fences[k:]

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if opened.get("a"):
                linked += len(text)

    while at < size:
        m = MARKUP.search(page, at)
        if m is None or (m.start() > ends.last and m.group() != "<!--"):
            add(page[at:])
            break
        start, kind = m.start(), m.group()
        add(page[at:start])
        if kind == "<!--":
            at = page.find("-->", start + 2)
            at = at + 3 if at >= 0 else size
            continue
        if kind in ("<!", "<?"):
            at = page.find(">", start) + 1
            continue
        m = PLAIN_TAG.match(page, start)
        if m:
            at, (ending, tag, rest) = m.end(), m.groups()
        else:
            m = TAG_NAME.match(page, start)
            at = ends.find(m.end()) + 1
            ending, tag, rest = m.group(1), m.group(2), page[m.end() : at - 1]
        tag = tag.lower()
        if ending:
            if opened.get(tag):
                k = len(tags) - 1
                while tags[k] != tag:
                    k -= 1
                if tag in BLOCK:
                    close()
                leave(k)
            continue
        if tag in RAW:
            found = None if tag in endless else re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if found:
                at = found.end()
            elif tag in CODE:
                at = size
            else:
                endless.add(tag)
            parts.append(" ")
            continue
        if tag in BLOCK:
            close()
            if tag in CLOSES_P and fences and fences[-1] >= 0 and tags[fences[-1]] == "p":
                leave(fences[-1])
            if tag in ("li", "td", "th", "tr", "dd", "dt", "option") and tags and tags[-1] == tag:
                leave(len(tags) - 1)
        if tag in VOID:
            if tag in ("br", "hr"):
                parts.append(" ")
            continue
        words, hidden = contexts.described(rest) if "=" in rest or "hidden" in rest else ((), False)
        fences.append(len(tags) if tag in BLOCK else fences[-1] if fences else -1)
        tags.append(tag)
        opened[tag] = opened.get(tag, 0) + 1
        path.append(contexts.below(path[-1], tag, words, hidden or tag == "template"))
    close()
    return out


def context_features(c: Context) -> list[str]:
    """Features of a block's ancestors; the innermost sectioning and the innermost named element count by themselves too."""
    return sorted({*c.names, *([f"p:{c.tag}"] if c.tag else []), *(f"i:{w}" for w in c.named), *([f"s:{c.section}"] if c.section else [])})


def text_features(b: Block) -> list[str]:
    t = b.text
    n = len(t)
    return [
        f"n:{min(9, n.bit_length())}", f"l:{min(4, 4 * b.linked // max(1, n))}", f"w:{min(7, (t.count(' ') + 1).bit_length())}",
        "end:" + ("stop" if t[-1] in ".!?:;…\"”»" else "none"), "mark:" + ("c" if t[0] == "©" else "n"),
    ]


class Field:
    """A trained chain: scores of features for both states, of starting states and of transitions."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, start: np.ndarray, move: np.ndarray):
        self.index, self.weights, self.start, self.move = index, weights, start, move
        self.contexts = Contexts(set(index))

    def __reduce__(self):
        return Field, (self.index, self.weights, self.start, self.move)

    def emission(self, b: Block) -> np.ndarray:
        if b.context.score is None:
            b.context.score = self._sum(context_features(b.context))
        return b.context.score + self._sum(text_features(b))

    def _sum(self, names: list[str]) -> np.ndarray:
        ids = [self.index[n] for n in names if n in self.index]
        return self.weights[ids].sum(0) if ids else np.zeros(2)

    def decode(self, page: list[Block]) -> list[bool]:
        """Viterbi: the likeliest sequence of states; True is main text."""
        if not page:
            return []
        (m00, m01), (m10, m11) = self.move.tolist()
        e = [self.emission(b).tolist() for b in page]
        a0, a1 = float(self.start[0]) + e[0][0], float(self.start[1]) + e[0][1]
        back = []
        for e0, e1 in e[1:]:
            f0, f1 = a1 + m10 > a0 + m00, a1 + m11 >= a0 + m01
            back.append((f0, f1))
            a0, a1 = (a1 + m10 if f0 else a0 + m00) + e0, (a1 + m11 if f1 else a0 + m01) + e1
        state = a1 >= a0
        out = [state]
        for f in reversed(back):
            state = f[state]
            out.append(state)
        return out[::-1]


# Labelled pages -----------------------------------------------------------------------------------

MARK = "\ue000"
# Attributes of elements that a reader doesn't see.
UNSEEN = ["hidden", "style='display:none'", 'style="display: none"', "style='visibility:hidden'", 'hidden=""', "hidden=hidden"]
# Names that sites give to parts of a page.
MAIN_NAMES = ["content", "post-content", "entry-content", "article-body", "story", "post", "main", "text", "body-text", "page-content"]
REST = {
    "nav": ["menu", "nav", "navbar", "breadcrumb", "topnav", "navigation", "breadcrumbs", "toc-menu"], "header": ["header", "masthead", "banner", "site-header", "topbar", "logo"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "legal"], "aside": ["sidebar", "widget", "related", "aside", "recommended", "trending", "side", "popular"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "sponsor"], "notice": ["cookie", "cookie-notice", "consent", "notice", "gdpr", "alert", "popup", "modal", "paywall", "overlay"],
    "form": ["newsletter", "subscribe", "login", "search", "signup", "contact-form", "search-form"], "comments": ["comments", "comment", "comment-list", "replies", "discussion", "responses", "reader-comments", "disqus", "comment-body"],
    "share": ["share", "social", "share-buttons", "tags", "follow"],
}


def _labelled_page(rnd: random.Random) -> str:
    """One page; its main blocks begin with MARK. Texts are made of invented syllables, so tags, names and shape carry the signal."""
    syllables = ["ta", "ren", "mo", "li", "ver", "sun", "dor", "ki", "pal", "est", "en", "or", "ul", "fa"]

    def word() -> str:
        return "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))

    def sentence(lo: int, hi: int) -> str:
        w = [word() for _ in range(rnd.randint(lo, hi))]
        style = rnd.random()
        if style < 0.06:
            w = [x + rnd.choice(["###", "%%%", "&amp;&amp;&amp;", "***", "$$$"]) for x in w]
        elif style < 0.1:
            w = [x.upper() + "!!" for x in w]
        elif style < 0.13:
            return " | ".join(w)
        return " ".join(w).capitalize() + rnd.choice([".", ".", ".", "!", "?", "", ""])

    def prose(most: int = 8) -> str:
        return " ".join(sentence(1, 22) for _ in range(rnd.randint(1, most)))

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(n))

    def named(kind: str, tag: str | None = None) -> tuple[str, str]:
        tag = tag or rnd.choice(["div", "section", "div", {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, "div")])
        name = rnd.choice(REST[kind])
        attr = rnd.choice(["class", "id", "class", "none"]) if tag not in ("div", "section") else rnd.choice(["class", "id"])
        return (f"<{tag}>" if attr == "none" else f'<{tag} {attr}="{name}">'), f"</{tag}>"

    def rest(kind: str) -> str:
        a, z = named(kind)
        if kind in ("nav", "share"):
            return f"{a}<ul>{links(rnd.randint(2, 8))}</ul>{z}"
        if kind == "header":
            return f"{a}<a href='/'>{word()}</a><{(h := rnd.choice(['h1', 'div', 'p', 'span']))}>{sentence(1, 6)}</{h}>{z}"
        if kind == "footer":
            return f"{a}{rnd.choice(['', '<p>'])}&copy; {word()}.com &middot; {sentence(2, 12)}{z}"
        if kind == "aside":
            inner = rnd.choice([f"<h3>{sentence(1, 4)}</h3><ul>{links(4)}</ul>", f"<p>{prose(3)}</p>", f"<h4>{word()}</h4><p>{prose(2)}</p>"])
            return f"{a}{inner}{z}"
        if kind == "comments":
            one = rnd.choice(["li", "div class='comment'", "article", "p", "div"])
            end = one.split()[0]
            body = "".join(f"<{one}>{rnd.choice(['', f'<b>{word()}</b> '])}<p>{prose(4)}</p></{end}>" for _ in range(rnd.randint(1, 6)))
            return f"{named('comments')[0].replace('section', 'div') if end == 'x' else a}{rnd.choice(['', f'<h3>{word()}</h3>'])}{body}{z}"
        if kind == "form":
            return f"<form class='{rnd.choice(REST['form'])}'><label>{sentence(1, 6)}</label><input name=q><p>{sentence(2, 12)}</p><button>{word()}</button></form>"
        return f"{a}{rnd.choice(['', '<p>'])}{prose(3)}{rnd.choice(['', f'<a href=x>{word()}</a>'])}{z}"

    def control() -> str:
        """Something to click or to fill in outside of any form, or words inside a drawing."""
        kind = rnd.random()
        if kind < 0.25:
            return "<select>" + "".join(f"<option>{sentence(1, 3)}</option>" for _ in range(rnd.randint(2, 5))) + "</select>"
        if kind < 0.5:
            return f"<button>{sentence(1, 4)}</button>"
        if kind < 0.7:
            return f"<label>{sentence(1, 5)}</label><input name=q>"
        if kind < 0.8:
            return f"<fieldset><legend>{sentence(1, 3)}</legend><label>{sentence(1, 4)}</label></fieldset>"
        return f"<svg{rnd.choice(['', ' viewBox=0'])}>{rnd.choice(['', f'<title>{word()}</title>'])}{rnd.choice(['', '<g>'])}<text>{sentence(1, 3)}</text></svg>"

    def main() -> str:
        out = []
        if rnd.random() < 0.8:
            out.append(f"<h1>{MARK}{sentence(2, 12)}</h1>")
        if rnd.random() < 0.3:  # a short line or two to begin with
            out += [f"<p>{MARK}{sentence(1, 4)}</p>" for _ in range(rnd.randint(1, 2))]
        for _ in range(rnd.randint(1, 14)):
            k = rnd.random()
            if k < 0.62:
                out.append(f"<p>{MARK}{prose()}" + rnd.choice(["</p>", "</p>", "</p>", ""]))
            elif k < 0.7:
                out.append(f"<p><b>{MARK}{sentence(1, 8)}<br><p>{MARK}{prose()}</p>")
            elif k < 0.78:
                out.append(f"<h{rnd.randint(2, 4)}>{MARK}{sentence(1, 6)}</h2>".replace("</h2>", "") + "</h2></h3></h4>")
            elif k < 0.83:
                out.append("<ul>" + "".join(f"<li>{MARK}{sentence(1, 15)}</li>" for _ in range(rnd.randint(2, 5))) + "</ul>")
            elif k < 0.87:
                out.append(f"<blockquote>{rnd.choice(['', '<p>'])}{MARK}{prose(3)}</blockquote>")
            elif k < 0.9:
                out.append(f"<figure><img src=x><figcaption>{MARK}{sentence(2, 9)}</figcaption></figure>")
            elif k < 0.92:
                out.append("<table><tr>" + "".join(f"<td>{MARK}{word()}</td>" for _ in range(4)) + "</tr></table>")
            elif k < 0.94:
                out.append(f"<div>{MARK}{prose(3)}</div>")
            elif k < 0.96:
                out.append(f"<{(t := rnd.choice(['p', 'div', 'section', 'h3', 'li']))} {rnd.choice(UNSEEN)}>{prose(3)}</{t}>")
            else:
                out.append(rest(rnd.choice(["ad", "share", "aside", "notice", "form"])))
            if rnd.random() < 0.06:
                out.append(control())
        if rnd.random() < 0.2:
            out.append(rest("comments"))
        return "".join(out)

    kind = rnd.random()
    if kind < 0.06:  # nothing but text, without a container or in one without a telling name
        frame = rnd.choice(["{}", "{}", "<div>{}</div>", f"<div id={word()}>{{}}</div>", f"<div class='{word()} {word()}'><div>{{}}</div></div>", "<section>{}</section>"])
        inner = "".join([f"<h1>{MARK}{sentence(2, 12)}</h1>"] * (rnd.random() < 0.6) + [f"<p>{MARK}{prose()}</p>" for _ in range(rnd.randint(1, 6))])
        return rnd.choice(["{}", "<html><body>{}</body></html>", "<!DOCTYPE html><html><head><title>x</title></head><body>{}"]).format(frame.format(inner))
    body = [rest(k) for k in ("notice", "header", "nav", "ad", "aside") if rnd.random() < 0.55]
    if rnd.random() < 0.1:
        body.append(f"<noscript>{prose(2)}</noscript>")
    rnd.shuffle(body)
    name = rnd.choice(MAIN_NAMES)
    if kind < 0.16:
        body.append(rnd.choice(["{}", "{}", "<div>{}</div>", f"<div id={word()}>{{}}</div>", f"<div class='{word()} {word()}'><div>{{}}</div></div>"]).format(main()))
    elif kind < 0.58:
        body.append(f"<article{rnd.choice(['', f' class={name!r}'])}>{main()}</article>")
    elif kind < 0.72:
        body.append(f"<main>{rnd.choice(['', f'<div class={name!r}>'])}{main()}</main>")
    elif kind < 0.85:
        body.append(f"<main><article>{main()}</article></main>")
    else:
        body.append(f"<div {rnd.choice(['class', 'id'])}={name!r}>{main()}</div>")
    body += [rest(k) for k in rnd.sample(["comments", "aside", "ad", "form", "share", "footer", "notice"], rnd.randint(1, 5))]
    if rnd.random() < 0.7:
        body.append(rest("footer"))
    text = f"<!DOCTYPE html><html><head><title>{word()}</title></head><body>" + "".join(body)
    return text + "</body></html>" * (rnd.random() < 0.9)


def labelled_pages(n: int = PAGES, seed: int = 7, contexts: Contexts | None = None) -> list[tuple[list[Block], list[bool]]]:
    rnd, out, contexts = random.Random(seed), [], contexts or Contexts()
    for _ in range(n):
        page = blocks(_labelled_page(rnd), contexts)
        labels = [MARK in b.text for b in page]
        for b in page:
            b.text = b.text.replace(MARK, "") or "."
        out.append((page, labels))
    return out


def train(pages: list[tuple[list[Block], list[bool]]], epochs: int = EPOCHS, step: float = STEP, penalty: float = PENALTY) -> Field:
    """Maximise the mean conditional log-likelihood of the labels; pages are padded and run together."""
    index: dict[str, int] = {}
    rows = [[[index.setdefault(f, len(index)) for f in context_features(b.context) + text_features(b)] for b in page] for page, _ in pages]
    n, longest = len(pages), max(map(len, rows))
    at = [(i, t, f) for i, page in enumerate(rows) for t, fs in enumerate(page) for f in fs]
    pi, ti, fi = (np.array(x) for x in zip(*at))
    cell = pi * longest + ti  # ascending: a block's features lie together
    begins = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.array([len(r) for r in rows])
    real = np.arange(longest)[None] < size[:, None]
    y = np.zeros((n, longest), int)
    for i, (_, labels) in enumerate(pages):
        y[i, : len(labels)] = labels
    gold = np.eye(2)[y] * real[..., None]
    w, start, move = np.zeros((len(index), 2)), np.zeros(2), np.zeros((2, 2))
    params = [w, start, move]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    both = real[:, 1:]
    seen_moves = np.einsum("nta,ntb->ab", gold[:, :-1] * both[..., None], gold[:, 1:])
    for k in range(1, epochs + 1):
        e = np.zeros((n * longest, 2))
        e[cell[begins]] = np.add.reduceat(w[fi], begins)
        e = e.reshape(n, longest, 2)
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = start + e[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(fwd[:, t - 1, :, None] + move, axis=1) + e[:, t]
            fwd[:, t] = np.where(real[:, t, None], new, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(move + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
            bwd[:, t] = np.where(real[:, t + 1, None], new, 0)
        z = np.logaddexp.reduce(fwd[:, -1], axis=1)
        post = np.exp(fwd + bwd - z[:, None, None]) * real[..., None]
        pair = np.exp(fwd[:, :-1, :, None] + move + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[..., None, None]
        diff = gold - post
        change = diff.reshape(-1, 2)[cell]
        gw = np.stack([np.bincount(fi, change[:, k], len(index)) for k in (0, 1)], axis=1)
        grads = [gw / n - penalty * w, diff[:, 0].sum(0) / n, (seen_moves - pair.sum((0, 1))) / n]
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += step * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Field(index, w, start, move)


@lru_cache(1)
def default_field() -> Field:
    return train(labelled_pages())


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page, field.contexts) if page else []
    text = "\n".join(b.text for b, keep in zip(found, field.decode(found)) if keep)
    field.contexts.trim()
    return text


def extract_text(pages: DataFrame, html: str = "html", out: str = "text", field: Field | None = None) -> DataFrame:
    """Add the page's main text to every row, whole pages read; a null or empty page gives an empty text.

    Blocks are joined by one newline. Pages of any length and depth take time in proportion; repeated rows
    are read alike and stay; an empty table gives an empty result. Other columns stay, an input column
    named `out` goes.
    """
    small_batches(pages.sparkSession)
    field = field or default_field()
    keep = [c for c in pages.columns if c != out]
    base = pages.select([F.col(f"`{c}`") for c in keep])
    shape = base.select("*", F.lit("").alias(out)).schema
    at = keep.index(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = [main_text(p, field).encode("utf-8", "replace") for p in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*keep, out])

    return base.mapInArrow(run, shape)
