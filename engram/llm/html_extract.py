"""HTML extraction by a recurrent block labeller.

A page is walked once into its leaf blocks: runs of text between block-level tags
and line breaks, each with its path of open elements (tag names, class, id and role
words). A bidirectional LSTM in numpy reads the whole sequence of a page's blocks -
hashed path vectors, hashed word vectors and a few measures of each block - and
labels every block as main text or not with the context of the whole document. Main
blocks are joined in page order.

The labeller is trained here on ``TRAIN_PAGES`` pages made by rule (``made_page``:
articles and plain bodies inside menus, banners, sidebars, notices, adverts, forms,
comment lists and footers, in many namings, also nested), a bound that does not
depend on the data; its weights (some 100 kB) are broadcast.

Defined results: a null or empty html, and a page without a main block, give an
empty text. Scripts, styles, titles, comments and other raw content are no blocks; a
head ends where something else than head content starts, and an unclosed drawing,
object, select, template or noscript at the next block-level tag;
character references are decoded once; white space inside a block becomes one
blank; a line break element ends a block; unclosed and stray tags are accepted as
browsers do for the common cases; pages are read whole; repeated rows give equal
texts; columns named like an added one give way to it.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import lru_cache
from html import unescape
from itertools import islice
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.llm.common import by_row, query, table

PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 512, 32, 7, 16
TRAIN_PAGES, EPOCHS, SEED = 1200, 10, 11
#: Open elements up to which a path names every one.
DEEP = 256
#: Blocks of a window, of a page that is read in windows, and of pages that are labelled together.
WINDOW, LONG, TOGETHER = 2048, 4096, 16384
#: HTML element classes (fixed values of the standard).
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noframes noembed xmp svg math object select".split())
#: Raw elements whose content is markup: without an end tag they end at the next block.
MARKUP = frozenset("noscript template svg math object select".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p "
                  "pre section summary table tbody td tfoot th thead tr ul br".split())
CLOSES_P = BLOCK - {"br", "button", "body", "html"}
_NEXT_BLOCK = re.compile(f"</?(?:{'|'.join(sorted(BLOCK - {'option', 'optgroup'}))})(?=[\\s/>])", re.I)
_ATTR = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_VALUE = re.compile(r""">|=\s*(?:["']|([^\s"'>][^\s>]*))""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TOKEN = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

#: Comments: complete when empty (``<!-->``, ``<!--->``), else up to their end; an open one takes the rest.
_EMPTY_COMMENT, _COMMENT_END = re.compile("<!--(?:-?>)"), re.compile("--!?>")

@lru_cache(4096)
def _words_of_attributes(attrs: str) -> tuple[str, ...]:
    return tuple(t.lower() for m in _ATTR.finditer(attrs) for t in _TOKEN.findall(m[1] or m[2] or m[3] or ""))


def _end_of_tag(html: str, at: int) -> int:
    """Index of the ``>`` that ends the tag at ``at`` (those in attribute values do not
    count, unless the quote never closes), or -1."""
    while m := _VALUE.search(html, at):
        if m.group() == ">":
            return m.start()
        at = m.end()
        if m.group()[-1] in "\"'" and not m[1]:
            close = html.find(m.group()[-1], at)
            if close < 0:
                return html.find(">", at)
            at = close + 1
    return -1


def _ends(html: str, tag: str) -> dict[int, int]:
    """End of each ``tag`` element by the start of its name; unclosed ones are missing."""
    out, waiting = {}, []
    for m in re.finditer(f"<(/?){tag}(?=[\\s/>])", html, re.I):
        if not m[1]:
            waiting.append(m.start() + 1)
        elif waiting:
            end = html.find(">", m.end())
            out[waiting.pop()] = end + 1 if end >= 0 else len(html)
    return out


def blocks(html: str | None) -> list[tuple[tuple, str, float]]:
    """(path, text, share of the text inside links) of every leaf block of a page.

    The path is a tuple of (tag, attribute words) of the open elements; of more than
    ``DEEP`` it holds the kinds in order of opening and the innermost ones."""
    out, text, linked = [], [], 0
    stack: list[tuple] = []
    kinds: dict[tuple, int] = {}
    opened: Counter = Counter()
    ends: dict[str, dict[int, int]] = {}
    pos, n = 0, len(html or "")

    def close(k):
        for e in stack[k:]:
            opened[e[0]] -= 1
            kinds[e] -= 1
            if not kinds[e]:
                del kinds[e]
        del stack[k:]

    def flush():
        nonlocal text, linked
        if text:
            raw = "".join(text)
            body = " ".join(unescape(raw).split())
            if body:
                path = tuple(stack) if len(stack) <= DEEP else (*islice(kinds, DEEP), *stack[-DEEP:])
                out.append((path, body, min(1.0, linked / max(1, len(raw)))))
            text, linked = [], 0

    while pos < n:
        lt = html.find("<", pos)
        if lt < 0:
            lt = n
        if lt > pos:
            text.append(html[pos:lt])
            if any(e[0] == "a" for e in stack[-3:]):
                linked += lt - pos
        if lt == n:
            break
        nxt = html[lt + 1:lt + 2]
        if nxt == "!" or nxt == "?":
            if empty := _EMPTY_COMMENT.match(html, lt):
                pos = empty.end()
            elif html.startswith("<!--", lt):
                end = _COMMENT_END.search(html, lt + 4)
                pos = end.end() if end else n
            else:
                end = html.find(">", lt)
                pos = end + 1 if end >= 0 else n
            continue
        closing = nxt == "/"
        m = _NAME.match(html, lt + 1 + closing)
        if not m:
            if not closing:
                text.append("<")
                pos = lt + 1
            else:
                end = html.find(">", lt)
                pos = end + 1 if end >= 0 else n
            continue
        end = _end_of_tag(html, m.end())
        if end < 0:
            break
        tag, pos = m.group().lower(), end + 1
        if tag in RAW and not closing:
            flush_first = tag in ("select", "textarea", "object", "iframe")
            if flush_first:
                flush()
            if html[end - 1] == "/" and tag in ("svg", "math"):
                continue
            if tag in MARKUP:
                if tag not in ends:
                    ends[tag] = _ends(html, tag)
                pos = ends[tag].get(lt + 1, 0)
                if not pos:
                    block = _NEXT_BLOCK.search(html, end)
                    pos = block.start() if block else n
                continue
            stop = re.compile(f"</{tag}\\s*>", re.I).search(html, pos)
            pos = stop.end() if stop else n
            continue
        if tag == "head":  # what it may hold is void or raw; anything else ends it
            continue
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in CLOSES_P and opened["p"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in CLOSES_P:
                    break
        if tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            same = ("dd", "dt") if tag[0] == "d" else ("td", "th") if tag in ("td", "th") else (tag,)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in same:
                    close(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "tr", "select", "menu"):
                    break
        stack.append((tag, _words_of_attributes(html[m.end():end]) if end > m.end() else ()))
        opened[tag] += 1
        kinds[stack[-1]] = kinds.get(stack[-1], 0) + 1
    flush()
    return out


# -- features --------------------------------------------------------------
@lru_cache(20000)
def _slot(token: str) -> int:
    return crc32(token.encode()) % PATH_DIM


@lru_cache(20000)
def path_vector(path: tuple) -> bytes:
    """Hashed vector of a path: tags, attribute words, and whether they are near."""
    v = np.zeros(PATH_DIM, np.float32)
    for depth, (tag, words) in enumerate(reversed(path)):
        v[_slot(f"t:{tag}")] = 1
        if depth < 2:
            v[_slot(f"{depth}:{tag}")] = 1
        for w in words:
            v[_slot(f"a:{w}")] = 1
    return v.tobytes()


def word_vector(text: str) -> np.ndarray:
    """Signed hashed vector of a block's distinct words, of length one at most."""
    words = set(text.lower().split())
    h = np.fromiter(map(crc32, map(str.encode, words)), np.int64, len(words))
    v = np.bincount(h % WORD_DIM, 1 - 2.0 * (h >> 16 & 1), minlength=WORD_DIM)
    return v / max(1, len(words))


def inputs(page: list[tuple], lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Feature rows of a page's blocks (of ``lo`` to ``hi``)."""
    n = len(page)
    hi = n if hi is None else min(hi, n)
    x = np.zeros((hi - lo, PATH_DIM + WORD_DIM + MEASURES), np.float32)
    for k, (path, text, linked) in enumerate(page[lo:hi]):
        i = lo + k
        x[k, :PATH_DIM] = np.frombuffer(path_vector(path), np.float32)
        x[k, PATH_DIM:PATH_DIM + WORD_DIM] = word_vector(text)
        x[k, -MEASURES:] = (min(1.0, np.log1p(len(text)) / 8), linked, text[-1] in ".!?:;\"", i == 0, i == n - 1, text[:1] == "©", 1)
    return x


# -- network ---------------------------------------------------------------
def _sig(x):
    return 1 / (1 + np.exp(-x))


def _lstm(x, w, u, mask, keep=None, state=None):
    """Hidden states (time, batch, HIDDEN); ``keep`` collects what training needs. ``state``
    [h, c] goes on from an earlier window and is left as it is after this one."""
    t, b = x.shape[:2]
    h, c = state if state is not None else (np.zeros((b, HIDDEN), x.dtype), np.zeros((b, HIDDEN), x.dtype))
    out = np.zeros((t, b, HIDDEN), x.dtype)
    pre = x @ w
    for k in range(t):
        z = pre[k] + h @ u
        i, f, o = _sig(z[:, :HIDDEN]), _sig(z[:, HIDDEN:2 * HIDDEN] + 1), _sig(z[:, 2 * HIDDEN:3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[k][:, None]
        c2 = f * c + i * g
        tc = np.tanh(c2)
        if keep is not None:
            keep.append((i, f, o, g, c, tc, h, m))
        c, h = m * c2 + (1 - m) * c, m * o * tc + (1 - m) * h
        out[k] = h
    if state is not None:
        state[:] = h, c
    return out


def _lstm_back(x, w, u, kept, dout):
    dw, du = np.zeros_like(w), np.zeros_like(u)
    dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
    for k in range(len(kept) - 1, -1, -1):
        i, f, o, g, c, tc, h, m = kept[k]
        dh = dh + dout[k]
        dhm, dcm = dh * m, dc * m
        dc2 = dcm + dhm * o * (1 - tc * tc)
        dz = np.concatenate((dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), dhm * tc * o * (1 - o), dc2 * i * (1 - g * g)), 1)
        dw += x[k].T @ dz
        du += h.T @ dz
        dh, dc = dh * (1 - m) + dz @ u.T, dc * (1 - m) + dc2 * f
    return dw, du


def _flip(a, lens):
    """Reverse every sequence of a (time, batch, ...) array within its length."""
    t = np.arange(a.shape[0])[:, None]
    at = np.where(t < lens, lens - 1 - t, t)
    return a[at, np.arange(a.shape[1])[None, :]]


class Labeller:
    """Bidirectional LSTM with a logistic output over both directions and the input."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + MEASURES
        s = lambda *shape: (r.normal(size=shape) * 0.15).astype(np.float32)
        self.p = [s(d, 4 * HIDDEN), s(HIDDEN, 4 * HIDDEN), s(d, 4 * HIDDEN), s(HIDDEN, 4 * HIDDEN), s(2 * HIDDEN), s(d) * 0]

    @staticmethod
    def _batch(pages):
        lens = np.array([len(p) for p in pages])
        x = np.zeros((lens.max(), len(pages), pages[0].shape[1]), np.float32)
        for k, p in enumerate(pages):
            x[:len(p), k] = p
        return x, lens, (np.arange(lens.max())[:, None] < lens).astype(np.float32)

    def _scores(self, pages, kept=None):
        x, lens, mask = self._batch(pages)
        fw, fu, bw, bu, v, direct = self.p
        back = _flip(x, lens)
        h1 = _lstm(x, fw, fu, mask, None if kept is None else kept[0])
        h2 = _flip(_lstm(back, bw, bu, mask, None if kept is None else kept[1]), lens)
        return x, back, lens, mask, h1, h2, h1 @ v[:HIDDEN] + h2 @ v[HIDDEN:] + x @ direct

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """True for main blocks, page by page; pages run together with others of like length."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            longest, end = len(pages[order[at]]), at + 1
            while end < len(order) and end - at < 256 and (end - at) * len(pages[order[end]]) < 4000 + longest:
                end += 1
            part = order[at:end]
            *_, s = self._scores([pages[k] for k in part])
            for j, k in enumerate(part):
                out[k] = s[:len(pages[k]), j] > 0
            at = end
        return out

    def label_long(self, page: list[tuple], window: int = WINDOW) -> np.ndarray:
        """The same for one page of any length, from its blocks: features are made window by
        window, once in each direction, and only the network's state and one number a
        block are kept in between."""
        n = len(page)
        fw, fu, bw, bu, v, direct = self.p
        score, zero = np.zeros(n, np.float32), lambda: [np.zeros((1, HIDDEN), np.float32) for _ in range(2)]
        state, starts = zero(), range(0, n, window)
        for lo in starts:
            x = inputs(page, lo, lo + window)
            h = _lstm(x[:, None], fw, fu, np.ones((len(x), 1), np.float32), None, state)
            score[lo:lo + len(x)] = h[:, 0] @ v[:HIDDEN] + x @ direct
        state = zero()
        for lo in reversed(starts):
            x = inputs(page, lo, lo + window)[::-1]
            h = _lstm(x[:, None], bw, bu, np.ones((len(x), 1), np.float32), None, state)
            score[lo:lo + len(x)] += (h[:, 0] @ v[HIDDEN:])[::-1]
        return score > 0

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = 0.01) -> Labeller:
        r = np.random.default_rng(SEED)
        m1, m2, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for epoch in range(epochs):
            order = sorted(r.permutation(len(pages)).tolist(), key=lambda k: len(pages[k]))
            batches = [order[a:a + 24] for a in range(0, len(order), 24)]
            for b in r.permutation(len(batches)).tolist():
                part, kept, step = batches[b], ([], []), step + 1
                x, back, lens, mask, h1, h2, s = self._scores([pages[k] for k in part], kept)
                y = np.zeros_like(s)
                for j, k in enumerate(part):
                    y[:len(labels[k]), j] = labels[k]
                ds = (_sig(s) - y) * mask / mask.sum()
                v = self.p[4]
                dv = np.concatenate(((h1 * ds[..., None]).sum((0, 1)), (h2 * ds[..., None]).sum((0, 1))))
                g1 = _lstm_back(x, self.p[0], self.p[1], kept[0], ds[..., None] * v[:HIDDEN])
                g2 = _lstm_back(back, self.p[2], self.p[3], kept[1], _flip(ds[..., None] * v[HIDDEN:], lens))
                grads = [*g1, *g2, dv, np.tensordot(ds, x, ((0, 1), (0, 1)))]
                lr = rate * (1 - epoch / epochs * 0.8) * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
                for k, g in enumerate(grads):
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.999 * m2[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - lr * (m1[k] / (np.sqrt(m2[k]) + 1e-8) + 1e-3 * self.p[k])).astype(np.float32)
        return self


# -- training pages ----------------------------------------------------------
#: Class and id words of what is not the article, by kind (fixed values).
ASIDE = {"nav": "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination pager tabs toc skip",
         "header": "header masthead banner topbar logo branding",
         "footer": "footer foot copyright legal colophon imprint bottom",
         "aside": "sidebar side aside widget related recommended popular trending tags widgets rail more teaser recent",
         "notice": "cookie cookies consent notice alert gdpr popup modal overlay banner disclaimer privacy warning toast",
         "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense dfp outbrain taboola",
         "form": "form search login signup subscribe newsletter contact register",
         "comments": "comments comment reply replies respond discussion disqus reader reactions commentlist",
         "share": "share sharing social follow"}
MAIN_WORDS = "article content post entry story body text main page single hentry"


def made_page(r: random.Random) -> tuple[str, list[str]]:
    """(html, main texts) of a page made by rule."""
    syllables = "the er on ti re st an ou en ha ing le de que ment ch und os la".split()

    def words(a, b):
        return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(a, b)))

    def sentence():
        return words(4, 25).capitalize() + r.choice([".", ".", ".", "!", "?", ""])

    def link():
        return f"<a href='/x'>{words(1, 3)}</a>"

    def kind_text(kind):
        if kind in ("nav", "share"):
            return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 8))) + "</ul>" if r.random() < 0.7 else " ".join(link() for _ in range(4))
        if kind == "footer":
            return r.choice(["&copy; ", "", "© 2024 "]) + words(2, 12) + r.choice(["", " &middot; " + sentence(), "<p>" + sentence() + "</p>"])
        if kind == "form":
            return f"<label>{words(1, 3)}</label><input name=q>" + r.choice([f"<p>{sentence()}</p>", "", f"<button>{words(1, 2)}</button>"])
        if kind == "comments":
            return r.choice([f"<h3>{words(1, 3)}</h3>", ""]) + "".join(
                r.choice([f"<p>{words(1, 2)}</p><p>{sentence()} {sentence()}</p>", f"<li>{sentence()}</li>", f"<div class=comment><p>{sentence()}</p></div>"]) for _ in range(r.randint(1, 5)))
        if kind == "aside":
            return f"<h3>{words(1, 3)}</h3>" * (r.random() < 0.5) + r.choice(["<p>" + sentence() + "</p>", "<ul>" + f"<li>{link()}</li>" * 3 + "</ul>", words(3, 20)])
        return r.choice([sentence(), f"<p>{sentence()}</p>", f"<p>{sentence()} {link()}</p>", words(2, 8) + f"<button>{words(1, 2)}</button>"])

    def boiler(kind):
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        w = r.choice(ASIDE[kind].split())
        name = r.choice([w, w, f"{w}-{r.choice(['box', 'area', 'wrap', 'list', 'section', 'inner', 'container', '1'])}", f"site-{w}", f"c-{w}__x", w.upper()])
        attr = r.choice([f' class="{name}"', f" id='{name}'", f' class="x {name} y"', f" class={w}"])
        if tag and r.random() < 0.6:
            return f"<{tag}{attr if r.random() < 0.4 else ''}>{kind_text(kind)}</{tag}>"
        t = r.choice(["div", "div", "div", "section", "aside", "p" if kind in ("ad", "notice") else "div"])
        return f"<{t}{attr}>{sentence() if t == 'p' else kind_text(kind)}</{t}>"

    mains: list[str] = []

    def main_text(a=1, b=6):
        t = " ".join(sentence() for _ in range(r.randint(a, b)))
        mains.append(" ".join(t.split()))
        return t

    def main_block():
        k = r.random()
        if k < 0.62:
            return f"<p>{main_text()}</p>" if r.random() < 0.85 else f"<p>{main_text()}"
        if k < 0.7:
            return f"<p><b>{main_text()}<br><p>{main_text()}</p>"
        if k < 0.78:
            h = r.choice(["h2", "h3", "h4"])
            return f"<{h}>{main_text(1, 1)}</{h}>"
        if k < 0.85:
            t = r.choice(["ul", "ol"])
            return f"<{t}>" + "".join(f"<li>{main_text(1, 2)}</li>" for _ in range(r.randint(1, 5))) + f"</{t}>"
        if k < 0.9:
            return f"<blockquote><p>{main_text()}</p></blockquote>"
        if k < 0.94:
            return f"<pre>{main_text()}</pre>"
        if k < 0.97:
            return "<table><tr>" + "".join(f"<td>{main_text(1, 1)}</td>" for _ in range(3)) + "</tr></table>"
        return f"<div>{main_text()}</div>"

    article = f"<h1>{main_text(1, 1)}</h1>" if r.random() < 0.85 else ""
    for _ in range(r.randint(1, 14)):
        article += main_block()
        if r.random() < 0.2:
            article += boiler(r.choice(["ad", "share", "aside", "form", "notice", "nav", "ad", "comments"]))
    inside = r.random() < 0.25
    if inside:
        article += boiler("comments")
    w = r.choice(MAIN_WORDS.split())
    wrap = r.choice(["<article>{}</article>"] * 5 + ["<main>{}</main>", f'<div class="{w}">{{}}</div>', f"<div id={w}>{{}}</div>", "<main><article>{}</article></main>",
                     f'<article class="post {w}">{{}}</article>', "<div>{}</div>", "{}", f'<section class="{w}-{r.choice(["body", "content", "text"])}">{{}}</section>'])
    before = [boiler(k) for k in r.sample(["nav", "header", "notice", "ad", "form", "share", "nav", "aside"], r.randint(0, 4))]
    after = [boiler(k) for k in r.sample(["comments", "aside", "ad", "share", "form", "notice", "nav"], r.randint(0, 4))] + [boiler("footer")] * (r.random() < 0.85)
    head = "<head><title>t</title><script>var t='</p>';</script></head>"
    return f"<html>{head}<body>{''.join(before)}{wrap.format(article)}{''.join(after)}</body></html>", mains


def training_set(n: int = TRAIN_PAGES, seed: int = SEED):
    r = random.Random(seed)
    pages, labels = [], []
    for _ in range(n):
        html, mains = made_page(r)
        page, wanted = blocks(html), set(mains)
        pages.append(inputs(page))
        labels.append(np.array([t in wanted for _, t, _ in page], np.float32))
    return pages, labels


@lru_cache(2)
def trained(n: int = TRAIN_PAGES) -> Labeller:
    """The labeller, trained once per driver process."""
    return Labeller().fit(*training_set(n))


def main_texts(htmls: list[str | None], model: Labeller) -> list[str]:
    """Main text of each page. Features of ``TOGETHER`` blocks are held at most."""
    out, group, size = [], [], 0

    def add(page, marks):
        out.append("\n".join(t for (_, t, _), keep in zip(page, marks) if keep))

    def flush():
        nonlocal group, size
        for page, marks in zip(group, model.label([inputs(p) for p in group])):
            add(page, marks)
        group, size = [], 0

    for html in htmls:
        page = blocks(html)
        if len(page) > LONG or size + len(page) > TOGETHER:
            flush()
        if len(page) > LONG:
            add(page, model.label_long(page))
        else:
            group.append(page)
            size += len(page)
    flush()
    return out


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", model: Labeller | None = None,
            keep: list[str] | None = None) -> DataFrame:
    """Add ``text_col``: the main text of every page."""
    bc = pages.sparkSession.sparkContext.broadcast(model or trained())
    return by_row(pages, [html_col], f"`{text_col}` string", lambda: lambda htmls: (main_texts(htmls, bc.value),),
                  keep=keep, slice_rows=256)


@query("op2_html_extract")
def op2_html_extract(spark: SparkSession, data_dir: str) -> DataFrame:
    """Main text of every page."""
    d = extract(table(spark, data_dir, "pages"), keep=["page_id", "url"])
    return d.withColumn("n_chars", F.length("text").cast("bigint"))
