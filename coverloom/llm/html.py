"""Main-text extraction: a recurrent block labeller.

A page is cut into blocks, the runs of text between block tags. Each block is a vector of learned parts for its tag path (names,
classes, ids and roles of the elements around it) and for its hashed words, with a few numbers. A bidirectional LSTM in numpy reads the
blocks of the whole page in order and says for each whether it belongs to the main text. It is trained, in a few seconds,
on pages that ``training_page`` makes up, where the truth is known.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_SLOTS, WORD_SLOTS, PATH_WIDTH, WORD_WIDTH, NUMBERS, HIDDEN = 4096, 1024, 24, 8, 6, 16

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub "
                   "sup time tt u var wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                   "menu nav ol p pre search section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>|<[!?/][^>]*+>", re.S)
_NAMED = re.compile(r"""(class|id|role|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PART = re.compile(r"[a-z]+")


def _tokens(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    if "=" in attributes or "hidden" in attributes:
        for name, *values in _NAMED.findall(attributes):
            value, name = "".join(values).lower(), name.lower()
            if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
                found.append("!hidden")
            elif name in ("class", "id", "role"):
                found += ["." + p for p in _PART.findall(value)]
    return tuple(found)


@dataclass
class Block:
    path: tuple[tuple[str, ...], ...]
    text: str
    linked: int  # characters inside links


def blocks(html: str) -> list[Block]:
    """Blocks with text, in page order; markup, comments, scripts, styles and titles are gone, references decoded, white space collapsed."""
    found: list[Block] = []
    stack: list[str] = []
    path: list[tuple[str, ...]] = []
    parts: list[str] = []
    here: tuple = ()  # the path at the block's first text
    links = linked = 0

    def text(raw: str) -> None:
        nonlocal here, linked
        if raw:
            if not here and raw.strip():
                here = tuple(p for p, t in zip(path, stack) if t not in INLINE)
            parts.append(raw)
            if links:
                linked += len(raw)

    def flush() -> None:
        nonlocal here, linked
        if parts:
            joined = "".join(parts)
            joined = " ".join((unescape(joined) if "&" in joined else joined).split())
            if joined:
                found.append(Block(here, joined, min(linked, len(joined))))
            parts.clear()
        here, linked = (), 0

    def pop(to: int) -> None:
        nonlocal links
        links -= stack[to:].count("a")
        del stack[to:], path[to:]

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            rest = html[at:]
            cut = re.search(r"<[a-zA-Z/!?]", rest)  # a tag that never ends
            text(rest[:cut.start()] if cut else rest)
            break
        text(html[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if not inline:
            flush()
        if m[1]:
            if tag in stack:
                pop(len(stack) - 1 - stack[::-1].index(tag))
            continue
        if tag == "br":
            text(" ")
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag in ENDS_P and "p" in stack:
            pop(len(stack) - 1 - stack[::-1].index("p"))
        elif tag in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in SCOPES[tag]:
                    break
                if stack[k] in CLOSES[tag]:
                    pop(k)
                    break
        if m[3].endswith("/") and tag in ("svg", "path", "circle", "rect", "use"):
            continue
        stack.append(tag)
        path.append(_tokens(tag, m[3]))
        links += tag == "a"
    flush()
    return found


@functools.lru_cache(maxsize=1 << 16)
def _slots(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    """Slots of a tag path: each name by itself and with its distance from the block, nearest eight elements and the outermost four."""
    near = path[-8:] if len(path) <= 12 else path[:4] + path[-8:]
    names = [t for tokens in near for t in tokens] + [f"{min(d, 4)}{t}" for d, tokens in enumerate(reversed(near)) for t in tokens]
    return np.array([crc32(t.encode()) % PATH_SLOTS for t in names or ["!root"]])


def _numbers(b: Block, k: int, n: int) -> list[float]:
    size = len(b.text)
    return [min(np.log1p(size) / 8, 1.5), b.linked / size, k / n, 1 / (1 + k), b.text[-1] in ".!?…:;\"'", min(len(b.path) / 10, 1.5)]


class Labeller:
    """Parameters and passes of the network. Sequences of a batch are padded; a mask keeps the state over padding."""

    def __init__(self, seed: int = 3):
        r, width = np.random.default_rng(seed), PATH_WIDTH + WORD_WIDTH + NUMBERS
        self.p = {"path": r.normal(0, 0.3, (PATH_SLOTS, PATH_WIDTH)), "word": r.normal(0, 0.1, (WORD_SLOTS, WORD_WIDTH)), "out": r.normal(0, 0.2, 2 * HIDDEN + 1)}
        for d in "fb":
            self.p[f"w{d}"] = r.normal(0, width**-0.5, (width, 4 * HIDDEN))
            self.p[f"u{d}"] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            self.p[f"c{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, pages: list[list[Block]], keep: bool = False):
        """(pages, longest, width) vectors and mask; with ``keep`` also what the backward pass needs."""
        longest = max(map(len, pages))
        x = np.zeros((len(pages), longest, PATH_WIDTH + WORD_WIDTH + NUMBERS), np.float32)
        mask, used, cache = np.zeros((len(pages), longest), np.float32), [], {}
        for i, page in enumerate(pages):
            mask[i, :len(page)] = 1
            words: list[int] = []
            starts = []
            for k, b in enumerate(page):
                slots = _slots(b.path)
                if b.path not in cache:
                    cache[b.path] = self.p["path"][slots].mean(axis=0)
                x[i, k, :PATH_WIDTH] = cache[b.path]
                x[i, k, PATH_WIDTH + WORD_WIDTH:] = _numbers(b, k, len(page))
                own = [crc32(w) % WORD_SLOTS for w in b.text.lower().encode().split(b" ")]
                starts.append(len(words))
                words += own
                if keep:
                    used.append((i, k, slots, np.array(own)))
            sizes = np.diff([*starts, len(words)])
            x[i, :len(page), PATH_WIDTH:PATH_WIDTH + WORD_WIDTH] = np.add.reduceat(self.p["word"][words], starts) / sizes[:, None]
        return x, mask, used

    def _run(self, x, mask, d: str, keep: bool):
        a, u = x @ self.p[f"w{d}"] + self.p[f"c{d}"], self.p[f"u{d}"]
        n, longest, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, kept = np.zeros((n, longest, HIDDEN), np.float32), []
        for t in range(longest) if d == "f" else range(longest - 1, -1, -1):
            z = a[:, t] + h @ u
            s = 1 / (1 + np.exp(-np.clip(z[:, :3 * HIDDEN], -30, 30)))
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            new, m = f * c + i * g, mask[:, t, None]
            th = np.tanh(new)
            if keep:
                kept.append((t, h, c, i, f, o, g, th, m))
            h, c = m * (o * th) + (1 - m) * h, m * new + (1 - m) * c
            out[:, t] = h
        return out, kept

    def scores(self, x, mask, keep: bool = False):
        f, kf = self._run(x, mask, "f", keep)
        b, kb = self._run(x, mask, "b", keep)
        h = np.concatenate([f, b], axis=2)
        return h @ self.p["out"][:-1] + self.p["out"][-1], h, kf, kb

    def gradients(self, x, mask, used, truth) -> dict[str, np.ndarray]:
        z, h, *kept = self.scores(x, mask, keep=True)
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth) * mask / mask.sum()
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"][:-1], g["out"][-1] = np.einsum("bt,bth->h", dz, h), dz.sum()
        dh, dx = dz[:, :, None] * self.p["out"][:-1], np.zeros_like(x)
        for part, (d, steps) in enumerate(zip("fb", kept)):
            u, own = self.p[f"u{d}"], dh[:, :, part * HIDDEN:(part + 1) * HIDDEN]
            da = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            nh, nc = np.zeros_like(own[:, 0]), np.zeros_like(own[:, 0])
            for t, h0, c0, i, f, o, gg, th, m in reversed(steps):
                nh = nh + own[:, t]
                to, ts = nh * m * th, nc * m + nh * m * o * (1 - th * th)
                dd = np.concatenate([ts * gg * i * (1 - i), ts * c0 * f * (1 - f), to * o * (1 - o), ts * i * (1 - gg * gg)], axis=1)
                da[:, t] = dd
                g[f"u{d}"] += h0.T @ dd
                nh, nc = dd @ u.T + nh * (1 - m), ts * f + nc * (1 - m)
            g[f"w{d}"] += np.einsum("btx,btz->xz", x, da)
            g[f"c{d}"] += da.sum(axis=(0, 1))
            dx += da @ self.p[f"w{d}"].T
        for i, k, slots, words in used:
            np.add.at(g["path"], slots, dx[i, k, :PATH_WIDTH] / len(slots))
            np.add.at(g["word"], words, dx[i, k, PATH_WIDTH:PATH_WIDTH + WORD_WIDTH] / len(words))
        return g

    def label(self, pages: list[list[Block]], cells: int = 1 << 15) -> list[np.ndarray]:
        """For each page, for each block, whether it is main text.

        Pages of like length share a batch of at most ``cells`` padded blocks, so one very long page costs its own blocks only.
        """
        out: list = [np.zeros(0, bool)] * len(pages)
        batches: list[list[int]] = [[]]
        for i in sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i])):
            if batches[-1] and (len(batches[-1]) + 1) * len(pages[i]) > cells:
                batches.append([])
            batches[-1].append(i)
        for some in filter(None, batches):
            z, *_ = self.scores(*self.inputs([pages[i] for i in some])[:2])
            for i, row in zip(some, z):
                out[i] = row[:len(pages[i])] > 0
        return out


#: Names that sites give to the parts around a text, to the text, and to neither.
AROUND = {
    "nav": "nav navbar navigation menu mainmenu topbar breadcrumb breadcrumbs pagination pager toc links",
    "header": "header masthead site-header page-header top branding logo",
    "footer": "footer site-footer page-footer bottom copyright legal imprint colophon",
    "aside": "sidebar side widget related recommended popular trending more teaser tags archive",
    "div": "ad ads advert advertisement sponsored sponsor promo banner cookie consent notice gdpr alert popup modal overlay newsletter subscribe share social "
           "sharing follow login signup paywall disclaimer warning",
    "section": "comments comment discussion replies responses respond feedback disqus reviews",
    "form": "form search searchform login contact signup newsletter poll survey",
}
TEXT_NAMES = "article post entry content main story body text article-body post-content entry-content page-content main-content markdown prose"
PLAIN_NAMES = "container wrapper row col inner outer grid box layout page site wrap group block clearfix left right center"
NOTICES = ("We use cookies to improve this site. Accept", "Subscribe to our newsletter", "All rights reserved.", "© 2024", "Share this", "Read more", "Log in", "Sign up now",
           "Advertisement", "Wir verwenden Cookies", "Alle Rechte vorbehalten", "Nous utilisons des cookies", "Tous droits réservés", "Usamos cookies",
           "Todos los derechos reservados", "Leave a reply", "Related articles", "Home", "About", "Contact", "Search", "Privacy policy")


@functools.cache
def _listed(names: str) -> list[str]:
    return names.split()


def training_page(r: random.Random) -> tuple[str, list[bool]]:
    """A made-up page and, for each of its blocks in order, whether it is main text."""
    out: list[str] = []
    truth: list[bool] = []
    pick = lambda names: r.choice(_listed(names) if isinstance(names, str) else names)
    syllables = pick(["th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve", "sch ein ich der die und gen ung ber ver keit lich tz zu",
                      "le de ment tion ou an eau eux qu es re on pa vi ch el", "os ción ar mente que ie ja do es la co ga an mi"]).split()
    junk = pick(["", "", "", "!!", "###", "***"])

    def prose(low: int, high: int) -> str:
        words = ["".join(r.choices(syllables, k=r.randrange(1, 5))) + (junk if r.random() < 0.7 else "") for _ in range(r.randrange(low, high + 1))]
        words = [w + "." if r.random() < 0.12 else w for w in words]
        return " ".join(words).capitalize() + ("." if r.random() < 0.8 else "")

    def block(text: str, tag: str, main: bool) -> None:
        truth.append(main)
        end = "" if tag in ("p", "li") and r.random() < 0.15 else f"</{tag}>"
        style = r.random()
        text = f"<b>{text}</b>" if style < 0.08 else f"<b>{text}<br>" if style < 0.14 else text
        out.append(f"<{tag}>{text}{end}")

    def named(names: str, more: str = "") -> str:
        kind, name = pick(["class", "class", "class", "id"]), pick(names)
        extra = f" {pick(PLAIN_NAMES)}" if r.random() < 0.3 and kind == "class" else ""
        return f' {kind}="{name}{extra}"{more}'

    def around(kind: str) -> None:
        """One part that isn't main text."""
        bare = r.random() < 0.35 and kind in ("nav", "header", "footer", "aside", "form")
        tag = kind if bare or r.random() < 0.4 else "div"
        out.append(f"<{tag}{'' if bare else named(AROUND[kind])}>")
        style = r.random()
        if kind in ("nav", "aside") and style < 0.75 or style < 0.2:
            out.append("<ul>")
            for _ in range(r.randrange(2, 9)):
                truth.append(False)
                out.append(f'<li><a href="/x">{prose(1, 4) if r.random() < 0.7 else pick(NOTICES)}</a>{"</li>" if r.random() < 0.8 else ""}')
            out.append("</ul>")
        elif kind == "form":
            for _ in range(r.randrange(1, 4)):
                block(prose(1, 5), pick("p div fieldset legend"), False)
            out.append('<input type="text"><br>')
            block(pick(NOTICES), "button", False)
        elif kind == "section":
            for _ in range(r.randrange(1, 7)):
                inner = pick(["div", "article", "li", "div"])
                out.append(f'<{inner} class="{pick("comment reply response message item")}">')
                for _ in range(r.randrange(1, 4)):
                    block(prose(2, 60), pick("p div p p"), False)
                out.append(f"</{inner}>")
        else:
            for _ in range(r.randrange(1, 4)):
                text = pick(NOTICES) + " " + prose(1, 12) if r.random() < 0.4 else prose(1, 40 if kind == "div" else 15)
                if r.random() < 0.35:
                    truth.append(False)
                    out.append(text)
                    break
                block(text, pick("p div span p h3" if kind != "header" else "h1 div p h2").replace("span", "p"), False)
        out.append(f"</{tag}>")

    def article() -> None:
        style = r.random()
        tag, attrs = ("article", "") if style < 0.35 else ("main", "") if style < 0.5 else ("article", named(TEXT_NAMES)) if style < 0.6 else ("", "") if style < 0.68 else \
            (pick("div div section"), named(TEXT_NAMES))
        if tag:
            out.append(f"<{tag}{attrs}>")
        if r.random() < 0.85:
            block(prose(1, 12), pick("h1 h1 h2"), True)
        for _ in range(r.randrange(1, 4) if r.random() < 0.2 else r.randrange(3, 25)):
            kind = r.random()
            if kind < 0.74:
                block(prose(1, 6) if r.random() < 0.15 else prose(6, 90), pick("p p p p p p div"), True)
            elif kind < 0.8:
                block(prose(1, 8), pick("h2 h3 h4"), True)
            elif kind < 0.86:
                out.append(pick(["<ul>", "<ol>"]))
                for _ in range(r.randrange(2, 6)):
                    block(prose(2, 15), "li", True)
                out.append("</ul></ol>")
            elif kind < 0.9:
                out.append("<blockquote>")
                block(prose(5, 40), "p", True)
                out.append("</blockquote>")
            elif kind < 0.93:
                out.append("<table>")
                for _ in range(r.randrange(1, 4)):
                    out.append("<tr>")
                    for _ in range(2):
                        block(prose(1, 4), "td", True)
                    out.append("</tr>")
                out.append("</table>")
            elif tag:
                around(pick(["div", "div", "aside", "nav", "form"]))
        if tag:
            if r.random() < 0.1:
                around(pick(["section", "div", "footer"]))
            out.append(f"</{tag}>")

    plain = r.randrange(0, 3)
    out.append("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>")
    out += [f"<div{named(PLAIN_NAMES) if r.random() < 0.8 else ''}>"] * plain
    for kind in ("header", "nav", "div", "aside", "form"):
        while r.random() < 0.4:
            around(kind)
    if r.random() < 0.97:
        article()
    for kind in ("section", "aside", "div", "form", "nav", "footer"):
        while r.random() < 0.4:
            around(kind)
    out += ["</div>"] * plain
    return "".join(out), truth


@functools.cache
def trained(pages: int = 1500, epochs: int = 5, seed: int = 5) -> Labeller:
    """A labeller trained on ``pages`` made-up pages; the same for the same arguments."""
    made_up, r, net = random.Random(seed), np.random.default_rng(seed), Labeller()
    made = []
    while len(made) < pages:
        html, truth = training_page(made_up)
        found = blocks(html)
        if found and len(found) == len(truth):
            made.append((found, np.array(truth, np.float32)))
    first, second, step = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2)), None, 0
    m, v = first
    for epoch in range(epochs):
        order = sorted(range(pages), key=lambda i: len(made[i][0]) + r.random() * 8)
        batches = [order[at:at + 24] for at in range(0, pages, 24)]
        for b in r.permutation(len(batches)):
            some = [made[i] for i in batches[b]]
            x, mask, used = net.inputs([s for s, _ in some], keep=True)
            truth = np.zeros_like(mask)
            for i, (_, t) in enumerate(some):
                truth[i, :len(t)] = t
            step += 1
            rate = 0.006 * (1 - 0.8 * epoch / epochs)
            for k, g in net.gradients(x, mask, used, truth).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                net.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)
    return net


def main_texts(htmls: list[str | None], net: Labeller) -> list[str]:
    pages = [blocks(h) if h else [] for h in htmls]
    return ["\n".join(b.text for b, main in zip(page, mains) if main) for page, mains in zip(pages, net.label(pages))]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", net: Labeller | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each page, its blocks joined by line feeds.

    Null, empty or blockless pages have an empty text and 0 characters. Null ids and urls stay, repeated rows are returned each, very long
    pages are read whole; other columns are ignored.
    """
    sent = pages.sparkSession.sparkContext.broadcast((net or trained()).p)  # parameters of fixed size

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Labeller()
        own.p = sent.value
        for column in columns:
            yield pa.array(main_texts(column.to_pylist(), own), pa.string())

    text = F.arrow_udf(run, "string")
    found = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text(F.col(html_col)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
