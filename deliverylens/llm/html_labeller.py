"""HTML main-text extraction by a recurrent block labeller.

A page is cut into leaf blocks (text between block-level tags). Each block is a
vector of its hashed tag path, its hashed words and a few counts. Of the path it says
which tags, classes and ids are open, not how often: containers without a name
(div and the like) say nothing, so that wrappers of any depth change nothing; a bidirectional LSTM in numpy reads the page's blocks in order and
labels each as article or not, so that a block's verdict draws on the whole
page. The network is trained here, on pages from a template generator whose
labels are known.

A page is scanned once from left to right, whatever its markup. A tag whose
quotes never close ends at the next ``>``; one that no ``>`` ends is no text.
Long pages are read in pieces of PIECE blocks with the states carried over, in
both directions, so memory beyond the blocks themselves is bounded.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .session import workers_import_this

PATH_DIM, WORD_DIM, COUNTS = 512, 16, 6
DIM = PATH_DIM + WORD_DIM + COUNTS
HIDDEN = 16
TRAIN_PAGES, EPOCHS, SEED = 1600, 10, 5
#: Blocks of a long page that are in memory as vectors at once.
PIECE = 4096
#: Tags that only hold others, whatever their number.
PLAIN_TAGS = frozenset("html body div span".split())

#: Fixed values of HTML: elements that end a block, that have no content, and whose content is no markup.
BLOCK_TAGS = frozenset("address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW_TAGS = frozenset("script style textarea title template iframe svg math".split())
#: Elements of other vocabularies, which a slash before the > closes; on HTML elements it means nothing.
FOREIGN_TAGS = frozenset("svg math".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NO_P = frozenset(BLOCK_TAGS - {"button", "option", "select", "iframe", "title", "head", "html", "body", "legend", "caption"})

_OPEN = re.compile(r"<(?:(!--)|([!?]|/(?![a-zA-Z]))|(/?)([a-zA-Z][^\s/>]*))")
_COMMENT_END = re.compile(r"--!?>")
_QUOTE_OR_END = re.compile(r"[\"'>]")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[\s_-]+")


class Block:
    """A leaf: the slots of its open tags and of their words of class, id and role, its text, and how much of it is links."""

    __slots__ = ("path", "text", "link")

    def __init__(self, path: tuple, text: str, link: int):
        self.path, self.text, self.link = path, text, link


def _read_names(attrs: str) -> tuple[str, ...]:
    found = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs)).lower()
    return tuple(x for x in _SPLIT.split(found) if x)


_cached_names = lru_cache(maxsize=4096)(_read_names)


def _names(attrs: str) -> tuple[str, ...]:
    return _cached_names(attrs) if len(attrs) <= 1000 else _read_names(attrs)


def markup(page: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """(start, end, name, whether it closes, attributes) of each tag in order;
    the name is null for comments and declarations.

    The caller may send a later place to go on from. Places from which the
    quotes lead to no end are remembered, so each is tried once.
    """
    at, dead = 0, set()
    while True:
        m = _OPEN.search(page, at)
        if m is None:
            return
        at = m.end()
        if m[1]:
            if page.startswith((">", "->"), at):
                at = page.index(">", at) + 1
            else:
                end = _COMMENT_END.search(page, at)
                at = end.end() if end else len(page)
            tag = (m.start(), at, None, False, "")
        else:
            i, tried, stop = at, [], -1
            while stop < 0 and m[4] and not m[3] and i not in dead:
                tried.append(i)
                q = _QUOTE_OR_END.search(page, i)
                if q is None:
                    break
                if q[0] == ">":
                    stop = q.start()
                    break
                i = page.find(q[0], q.end()) + 1
                if not i:
                    break
            if stop < 0:
                dead.update(tried)
                stop = page.find(">", at)
            inner = page[at : stop if stop >= 0 else len(page)]
            at = stop + 1 if stop >= 0 else len(page)
            tag = (m.start(), at, m[4].lower() if m[4] else None, bool(m[3]), inner)
        at = max(at, (yield tag) or 0)


def leaves(page: str | None) -> list[Block]:
    """The blocks of a page in order, white space and character references
    resolved; blocks without a character are left out."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    depth: dict[str, int] = {}
    level: list[int] = []  # where block-level tags lie in the stack
    parts: list[str] = []
    links = at = 0
    held = [0] * PATH_DIM  # how many open tags and names fall into each slot
    path: tuple | None = ()

    def close_block() -> None:
        nonlocal links, path
        if parts:
            text = " ".join(htmllib.unescape("".join(parts)).split())
            if text:
                if path is None:
                    path = tuple([k for k, n in enumerate(held) if n])
                out.append(Block((*path, _slot("leaf<" + stack[-1][0])) if stack else path, text, links))
            parts.clear()
        links = 0

    def count(name: str, names: tuple[str, ...], by: int) -> None:
        nonlocal path
        if name not in PLAIN_TAGS or names:
            path = None
            if name not in PLAIN_TAGS:
                held[_slot("<" + name)] += by
            for x in names:
                held[_slot("." + x)] += by

    def pop(name: str) -> None:
        while stack:
            top, names = stack.pop()
            count(top, names, -1)
            depth[top] -= 1
            if top in BLOCK_TAGS:
                level.pop()
            if top == name:
                break

    def take(stop: int) -> None:
        nonlocal links
        if stop > at:
            parts.append(page[at:stop])
            if depth.get("a"):
                links += stop - at

    tags = markup(page)
    tag = next(tags, None)
    while tag is not None:
        start, end, name, closes, attrs = tag
        take(start)
        at, jump = end, None
        if name == "br":
            parts.append(" ")
        elif name is not None and closes:
            if name in BLOCK_TAGS:
                close_block()
            if depth.get(name):
                pop(name)
        elif name is not None:
            if name in BLOCK_TAGS:
                close_block()
                if name in _NO_P and depth.get("p"):
                    pop("p")
                while level and stack[level[-1]][0] in _CLOSES.get(name, ()):
                    pop(stack[level[-1]][0])
            alone = name in FOREIGN_TAGS and attrs.rstrip().endswith("/")
            if name in RAW_TAGS and not alone:
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = jump = close.end() if close else len(page)
            elif name not in VOID_TAGS and not alone:
                if name in BLOCK_TAGS:
                    level.append(len(stack))
                stack.append((name, _names(attrs) if attrs else ()))
                count(*stack[-1], 1)
                depth[name] = depth.get(name, 0) + 1
        try:
            tag = tags.send(jump)
        except StopIteration:
            tag = None
    take(len(page))
    close_block()
    return out


@lru_cache(maxsize=65536)
def _slot(token: str) -> int:
    raw = np.frombuffer(token.encode(), dtype=np.uint8)
    return int(W.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0] % np.uint64(PATH_DIM))


@lru_cache(maxsize=16384)
def _path_vector(path: tuple) -> np.ndarray:
    v = np.zeros(PATH_DIM, dtype=np.float32)
    v[list(path)] = 1.0
    return v


def features(blocks: list[Block], at: int = 0, total: int | None = None, longest: int | None = None) -> np.ndarray:
    """One row of DIM values a block. For a piece of a page: the blocks before
    it, and the page's number of blocks and words of the longest."""
    x = np.zeros((len(blocks), DIM), dtype=np.float32)
    if not blocks:
        return x
    for k, b in enumerate(blocks):
        x[k, :PATH_DIM] = _path_vector(b.path)
    raw = "\n".join(b.text.lower() for b in blocks).encode()
    buf = np.frombuffer(raw, dtype=np.uint8)
    starts, ends = W.spans(buf)
    owner = np.concatenate(([0], np.cumsum(buf == 10)))[starts]
    slots = (W.word_hashes(buf, starts, ends) % np.uint64(WORD_DIM)).astype(np.int64)
    seen = np.bincount(owner * WORD_DIM + slots, minlength=len(blocks) * WORD_DIM).reshape(len(blocks), WORD_DIM)
    n = seen.sum(axis=1)
    x[:, PATH_DIM : PATH_DIM + WORD_DIM] = seen / np.maximum(n, 1)[:, None]
    chars = np.array([len(b.text) for b in blocks])
    stops = np.array([b.text.count(".") + b.text.count(",") for b in blocks])
    c = PATH_DIM + WORD_DIM
    x[:, c] = np.log1p(n) / 4
    x[:, c + 1] = np.minimum(np.array([b.link for b in blocks]) / np.maximum(chars, 1), 1)
    x[:, c + 2] = np.minimum(stops / np.maximum(n, 1), 1)
    x[:, c + 3] = (at + np.arange(len(blocks)) + 0.5) / (total or len(blocks))
    x[:, c + 4] = n / max(1, longest or n.max())
    x[:, c + 5] = chars / np.maximum(n, 1) / 10
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class BiLSTM:
    """Two LSTMs, one a direction, and a logistic layer over their states."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, seed: int) -> BiLSTM:
        r = np.random.default_rng(seed)
        w: dict[str, np.ndarray] = {}
        for d in "fb":
            w["x" + d] = r.normal(0, DIM**-0.5, (DIM, 4 * HIDDEN)).astype(np.float32)
            w["h" + d] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            w["b" + d] = np.repeat(np.array([0, 1, 0, 0], dtype=np.float32), HIDDEN)
        w["o"] = r.normal(0, 0.3, 2 * HIDDEN).astype(np.float32)
        w["c"] = np.zeros(1, dtype=np.float32)
        return cls(w)

    def _run(self, d: str, x: np.ndarray, live: np.ndarray, keep: list | None, state: list | None = None) -> np.ndarray:
        """States of one direction; x is (pages, blocks, DIM), live marks real
        blocks. ``state`` holds the states before and is given those after."""
        z = x @ self.w["x" + d] + self.w["b" + d]
        n, t = live.shape
        h, c = state or (np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32))
        out = np.zeros((n, t, HIDDEN), np.float32)
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            g = z[:, k] + h @ self.w["h" + d]
            s = _sigmoid(g[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            u, m = np.tanh(g[:, 3 * HIDDEN :]), live[:, k, None]
            c2 = f * c + i * u
            th = np.tanh(c2)
            if keep is not None:
                keep.append((k, h, c, i, f, o, u, th, m))
            h, c = np.where(m, o * th, h), np.where(m, c2, c)
            out[:, k] = h
        if state is not None:
            state[:] = h, c
        return out

    def scores(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        """The chance of each block to be article text."""
        both = np.concatenate([self._run("f", x, live, None), self._run("b", x, live, None)], axis=2)
        return _sigmoid(both @ self.w["o"] + self.w["c"][0])

    def page_scores(self, blocks: list[Block]) -> np.ndarray:
        """The same for one long page, in pieces."""
        total, longest = len(blocks), max(b.text.count(" ") + 1 for b in blocks)
        logit = np.full(total, self.w["c"][0], dtype=np.float32)
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            state: list = []
            starts = range(0, total, PIECE)
            for at in starts if d == "f" else reversed(starts):
                x = features(blocks[at : at + PIECE], at, total, longest)[None]
                logit[at : at + x.shape[1]] += self._run(d, x, np.ones(x.shape[:2], dtype=bool), None, state)[0] @ self.w["o"][part]
        return _sigmoid(logit)

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over the live blocks and its gradients."""
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._run(d, x, live, kept[d]) for d in "fb"], axis=2)
        p = _sigmoid(both @ self.w["o"] + self.w["c"][0])
        total = max(1, int(live.sum()))
        loss = float(-np.sum(live * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))) / total)
        err = ((p - y) * live / total).astype(np.float32)
        grads = {"o": np.einsum("nt,nth->h", err, both), "c": np.array([err.sum()], dtype=np.float32)}
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            dout = err[:, :, None] * self.w["o"][part]
            dz = np.zeros((*live.shape, 4 * HIDDEN), np.float32)
            dwh = np.zeros_like(self.w["h" + d])
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            for k, h, c, i, f, o, u, th, m in reversed(kept[d]):
                dh = dh + dout[:, k]
                a, through = dh * m, dh * ~m
                dct = (dc + a * o * (1 - th * th)) * m
                g = np.concatenate([dct * u * i * (1 - i), dct * c * f * (1 - f), a * th * o * (1 - o), dct * i * (1 - u * u)], axis=1)
                dz[:, k] = g
                dwh += h.T @ g
                dh = g @ self.w["h" + d].T + through
                dc = dct * f + dc * ~m
            grads["x" + d] = np.einsum("ntd,ntg->dg", x, dz, optimize=True)
            grads["h" + d] = dwh
            grads["b" + d] = dz.sum(axis=(0, 1))
        return loss, grads


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(1, max(len(r) for r in rows))
    x, live = np.zeros((len(rows), t, DIM), np.float32), np.zeros((len(rows), t), dtype=bool)
    for k, r in enumerate(rows):
        x[k, : len(r)], live[k, : len(r)] = r, True
    return x, live


class PageMaker:
    """Pages of invented words over varied templates, with the label of each block."""

    #: Names that templates use for parts around an article, and inside it.
    AROUND = {
        "menu": ("nav", "menu navbar navigation topnav breadcrumb breadcrumbs tabs"),
        "header": ("header", "header masthead site banner top branding logo"),
        "ad": ("div", "ad ads advert advertisement sponsor sponsored promo promotion banner"),
        "aside": ("aside", "sidebar side widget related recommended trending popular rail"),
        "notice": ("div", "notice cookie consent gdpr alert popup modal newsletter paywall warning message"),
        "form": ("form", "form search login subscribe signup contact"),
        "comments": ("section", "comments comment replies reply discussion disqus responses thread"),
        "footer": ("footer", "footer foot bottom copyright legal colophon"),
        "share": ("div", "share social sharing tools toolbar pagination pager tags meta"),
    }
    INSIDE = "content article post entry story body main text prose page wrap container inner"
    #: What containers are called that say nothing of what they hold.
    WRAP = "container row col wrapper wrap inner outer grid layout page site content main body section block holder box column flex"

    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)
        syllables = [a + b for a in "b c d f g l m n p r s t v w".split() for b in "a e i o u an er in on es".split()]
        self.words = ["".join(self.r.choice(syllables, self.r.integers(1, 5))) for _ in range(3000)]

    def text(self, least: int, most: int) -> str:
        picked = [self.words[int(k)] for k in (self.r.random(self.r.integers(least, most + 1)) ** 2 * len(self.words))]
        line = " ".join(w + ("," if self.r.random() < 0.08 else ". " if self.r.random() < 0.06 else "") for w in picked)
        return line[:1].upper() + line[1:] + ("." if self.r.random() < 0.8 else "")

    def _attrs(self, names: str) -> str:
        pool = names.split()
        if self.r.random() < 0.06:
            pool = [str(self.r.choice(self.words))]
        picked = "-".join(self.r.choice(pool, min(len(pool), int(self.r.integers(1, 3))), replace=False))
        kind = self.r.choice(["class", "id"], p=[0.8, 0.2])
        return f' {kind}="{picked}"'

    def wrapped(self, part: str, chance: float) -> str:
        """A part in nested containers, mostly few, now and then thirty, with names that say nothing or with none."""
        if self.r.random() >= chance:
            return part
        n = 30 if self.r.random() < 0.05 else int(self.r.geometric(0.45))
        for _ in range(n):
            roll = self.r.random()
            attrs = "" if roll < 0.4 else self._attrs(self.WRAP) if roll < 0.85 else f' class="{self.r.choice(self.words)}"'
            tag = "section" if self.r.random() < 0.08 else "div"
            part = f"<{tag}{attrs}>{part}</{tag}>"
        return part

    def _around(self, kind: str) -> tuple[str, int]:
        part, n = self._part(kind)
        return self.wrapped(part, 0.25), n

    def _part(self, kind: str) -> tuple[str, int]:
        """A part that is no article text: (html, number of blocks)."""
        tag, names = self.AROUND[kind]
        plain = self.r.random() < 0.4
        if plain or tag == "div":
            attrs = self._attrs(names) if tag == "div" or self.r.random() < 0.4 else ""
        else:
            tag, attrs = "div", self._attrs(names)
        n = int(self.r.integers(1, 7))
        if kind in ("menu", "share", "aside") and self.r.random() < 0.75:
            items = "".join(f'<li><a href="/{k}">{self.text(1, 4)}</a></li>' for k in range(n))
            return f"<{tag}{attrs}><ul>{items}</ul></{tag}>", n
        if kind == "form":
            return f"<{tag}{attrs}><label>{self.text(1, 4)}</label><input name='q'><button>{self.text(1, 2)}</button></{tag}>", 2
        if kind == "comments":
            own = "article" if self.r.random() < 0.15 else "div"
            return f"<{tag}{attrs}><h3>{self.text(1, 3)}</h3>" + "".join(f"<{own}{self._attrs('comment reply')}><p>{self.text(3, 60)}</p></{own}>" for _ in range(n)) + f"</{tag}>", n + 1
        if kind == "footer" or self.r.random() < 0.5:
            return f"<{tag}{attrs}>{'&copy; ' if kind == 'footer' else ''}{self.text(2, 60)}</{tag}>", 1
        return f"<{tag}{attrs}>" + "".join(f"<p>{self.text(2, 40)}</p>" for _ in range(n)) + f"</{tag}>", n

    def page(self) -> tuple[str, np.ndarray]:
        """(html, label of each block)."""
        out, labels = [], []

        def around(kinds: list[str], chance: float) -> None:
            for k in self.r.permutation(kinds):
                if self.r.random() < chance:
                    part, n = self._around(str(k))
                    out.append(part)
                    labels.extend([0] * n)

        around(["menu", "header", "ad", "notice", "form"], 0.5)
        style = self.r.random()
        opens, closes = ("<article>", "</article>") if style < 0.55 else ("<main>", "</main>") if style < 0.7 else (f"<div{self._attrs(self.INSIDE) if style < 0.85 else ''}>", "</div>") if style < 0.9 else ("<main><article>", "</article></main>")
        before, out = out, []
        if self.r.random() < 0.8:
            out.append(f"<h1>{self.text(2, 14)}</h1>")
            labels.append(1)
        again = f"<p>{self.text(1, 6)}</p>"
        for k in range(int(self.r.integers(1, 14))):
            roll = self.r.random()
            if roll < 0.1:
                n = int(self.r.integers(1, 6))
                out.append(again * n)
                labels.extend([1] * n)
            elif roll < 0.72:
                bold = self.r.random() < 0.25
                out.append(f"<p>{'<b>' if bold else ''}{self.text(1, 120)}{'<br>' if bold else ''}{'' if bold and self.r.random() < 0.5 else '</p>'}")
                labels.append(1)
            elif roll < 0.8:
                out.append(f"<h2>{self.text(1, 8)}</h2>")
                labels.append(1)
            elif roll < 0.86:
                n = int(self.r.integers(1, 5))
                out.append("<ul>" + "".join(f"<li>{self.text(1, 25)}</li>" for _ in range(n)) + "</ul>")
                labels.extend([1] * n)
            elif roll < 0.91:
                out.append(f"<blockquote><p>{self.text(3, 50)}</p></blockquote>" if self.r.random() < 0.5 else f"<pre>{self.text(3, 30)}</pre>")
                labels.append(1)
            elif roll < 0.95:
                out.append(f"<table><tr><td>{self.text(1, 5)}</td><td>{self.text(1, 5)}</td></tr></table>")
                labels.extend([1, 1])
            else:
                around(["ad", "share", "notice", "aside", "form"], 0.3)
        if self.r.random() < 0.25:
            around(["comments", "share"], 0.6)
        story = self.wrapped(opens + self.wrapped("".join(out), 0.35) + closes, 0.55)
        out = []
        around(["aside", "comments", "ad", "share", "form", "notice"], 0.3)
        beside, out = "".join(out), []
        around(["footer", "menu"], 0.7)
        body = self.wrapped("".join(before) + self.wrapped(story + beside, 0.3) + "".join(out), 0.4)
        return f"<html><head><title>{self.text(2, 8)}</title><style>p{{}}</style></head><body>{body}</body></html>", np.array(labels, dtype=np.float32)


@lru_cache(maxsize=2)
def trained(seed: int = SEED, pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> BiLSTM:
    """Fit the labeller with Adam on generated pages; the same weights for the same arguments."""
    maker, rows = PageMaker(seed), []
    while len(rows) < pages:
        page, y = maker.page()
        blocks = leaves(page)
        if len(blocks) == len(y):
            rows.append((features(blocks), y))
    net, r = BiLSTM.fresh(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for epoch in range(epochs):
        order = r.permutation(len(rows))
        for at in range(0, len(order), 16):
            part = [rows[k] for k in order[at : at + 16]]
            x, live = padded([f for f, _ in part])
            y = np.zeros(live.shape, np.float32)
            for k, (_, v) in enumerate(part):
                y[k, : len(v)] = v
            _, grads = net.gradients(x, live, y)
            step += 1
            rate = 0.01 * 0.75**epoch
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def label(pages: list[list[Block]], net: BiLSTM) -> list[np.ndarray]:
    """Which blocks of each page are article text; pages of like length run together."""
    out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order) and len(pages[order[at]]) <= PIECE:
        size = max(1, min(128, 16384 // len(pages[order[at]])))
        part = [k for k in order[at : at + size] if len(pages[k]) <= PIECE]
        x, live = padded([features(pages[k]) for k in part])
        scores = net.scores(x, live)
        for j, k in enumerate(part):
            out[k] = scores[j, : len(pages[k])] >= 0.5
        at += len(part)
    for k in order[at:]:
        out[k] = net.page_scores(pages[k]) >= 0.5
    return out


def extract(pages: DataFrame, *, id_col: str = "page_id", net: BiLSTM | None = None) -> DataFrame:
    """(id, url, text, n_chars): the article blocks in page order, one a line.

    A null or empty html, and a page without article blocks, give an empty
    text. Rows with equal or null ids are pages of their own; an empty table
    gives an empty result.
    """
    workers_import_this(pages.sparkSession)
    weights = (net or trained()).w
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = BiLSTM(weights)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                cut = [leaves(h.as_py()) for h in part.column(2)]
                texts = ["\n".join(b.text for b, keep in zip(bs, ks) if keep) for bs, ks in zip(cut, label(cut, model))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    out = pages.select(F.col(id_col).alias("id"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_col)
