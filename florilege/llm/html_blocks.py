"""Main text of web pages by a recurrent block labeller.

A page is scanned into blocks: runs of text between block-level tags, comments,
scripts and styles left out.  Each block is a vector of its tag path (tags and
the words of class, id and role, hashed), of its own words (hashed) and of a
few shapes (length, links, signs, place).  A bidirectional LSTM in numpy reads
the page's blocks in order, so that a block is judged with all others in view,
and the blocks labelled as article make the text.  A page of more than ``RUN``
blocks goes through the same network in slices of time that hand on their
states, in both directions: its blocks, too, are judged with all others in
view, and memory is bounded by the slice.

The labeller is trained when it is first used in a process, in some seconds,
on ``TRAINING_PAGES`` generated pages whose labels are known: templates with
random tags, class words, order, languages and omissions.  It is a function of
its seed, so that every worker that is given its weights, or trains anew, has
the same.  Weights have a fixed size (under 1 MB), whatever the input.

A null or empty page, or one without article, has an empty text; white space
within a block becomes one space, blocks are joined by one space; an empty
table gives an empty result; other columns don't matter; character
references are decoded; tags may nest to any depth, memory follows the page; tags are told by the HTML rules (stray and unquoted
quotes, a slash that closes nothing); markup that is never closed, or closed
twice, is read as far as it goes; repeated rows repeat.
"""

from __future__ import annotations

import html
import math
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from florilege.llm.words import map_slices

PATH_SLOTS, WORD_SLOTS, SHAPES = 384, 96, 16
FEATURES = PATH_SLOTS + WORD_SLOTS + SHAPES
HIDDEN = 24
TRAINING_PAGES, EPOCHS, SEED = 7000, 3, 7
#: Log odds from which a block is article: where precision and recall on held-out pages meet.
THRESHOLD = -0.5
#: Pages of more blocks are read alone, in slices of so many.
RUN = 2048
#: Blocks, with padding, of pages that are read side by side.
BATCH = 1 << 15

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img svg path".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text.
RAW = frozenset("script style noscript template textarea title svg math iframe object select option xmp".split())
FIELDS = frozenset("input textarea select".split())
#: Without an end tag they end where an element around them does; the others of RAW go to the end of the page.
ENCLOSED = frozenset("noscript template svg math object select option".split())
#: An open one is closed by a new one of these.
CLOSES = {"p": frozenset("p div ul ol dl table section article aside header footer nav form h1 h2 h3 h4 h5 h6 blockquote pre figure main address fieldset hr li".split()), "li": frozenset(["li"]), "td": frozenset("td th tr".split()), "th": frozenset("td th tr".split()), "tr": frozenset(["tr"]), "dt": frozenset("dt dd".split()), "dd": frozenset("dt dd".split())}
#: Attributes by the HTML rules; a quote that the page never closes is an ordinary sign.
_ATTRIBUTES = r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?+)?+)*+"
TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
PART = re.compile(r"[a-z]+")
SPACE = re.compile(r"[\s ]+")


class Node:
    """An open element: its tag and class words, the one around it, and the hash slots of its whole path as bits.

    Blocks share their path's nodes, so that a page takes memory by its size, however deep its tags go.
    """

    __slots__ = ("tag", "words", "around", "depth", "slots")

    def __init__(self, tag: str, words: tuple[str, ...], around: Node | None) -> None:
        self.tag, self.words, self.around, self.depth = tag, words, around, around.depth + 1 if around else 1
        self.slots = around.slots if around else 0
        for name in ("<" + tag, *(mark + w for w in words if len(w) > 1 for mark in ("", "~"))):
            self.slots |= 1 << _of_path[name]


class Block:
    """``path``: the innermost element.  ``before`` and ``behind``: whether fields of a form stand between this block and the next one."""

    __slots__ = ("path", "text", "linked", "bold", "depth", "before", "behind")

    def __init__(self, path: Node | None, text: str, linked: int, bold: int, before: bool) -> None:
        self.path, self.text, self.linked, self.bold, self.depth, self.before, self.behind = path, text, linked, bold, path.depth if path else 0, before, False


def _enclosed_end(page: str, at: int, tag: str, around: set[str], endless: set) -> int:
    """Where the content of a RAW element ends: behind its end tag, before that of an element ``around`` it, or at once if there is neither."""
    if (tag, frozenset(around)) in endless:
        return at
    inner: dict[str, int] = {}
    for m in TOKEN.finditer(page, at):
        if m[2] is None:
            continue
        name = m[2].lower()
        if not m[1]:
            if name in around and name not in VOID:
                inner[name] = inner.get(name, 0) + 1
        elif name == tag:
            return m.end()
        elif name in around:
            if not inner.get(name):
                return m.start()
            inner[name] -= 1
    endless.add((tag, frozenset(around)))
    return at


def scan(page: str | None) -> list[Block]:
    """Blocks of a page in order."""
    out: list[Block] = []
    stack: list[Node] = []
    open_tags: dict[str, int] = {}
    parts: list[str] = []
    state = {"linked": 0, "bold": 0, "fields": False}
    anchors = bolds = 0
    endless: set = set()
    page = page or ""

    def say(text: str) -> None:
        text = html.unescape(text)
        parts.append(text)
        n = len(text.strip())
        state["linked"] += n if anchors else 0
        state["bold"] += n if bolds else 0

    def close() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(stack[-1] if stack else None, text, state["linked"], state["bold"], state["fields"]))
                state["fields"] = False
            parts.clear()
        state["linked"] = state["bold"] = 0

    def leave() -> str:
        tag = stack.pop().tag
        open_tags[tag] -= 1
        if not open_tags[tag]:
            del open_tags[tag]
        return tag

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in FIELDS and not m[1]:
            close()
            state["fields"] = True
            if out:
                out[-1].behind = True
        if tag in RAW and not m[1]:
            if tag not in INLINE:
                close()
            if not (tag in ("svg", "math") and m[3].endswith("/")):  # a slash closes nothing else
                if tag in ENCLOSED:
                    at = _enclosed_end(page, at, tag, set(open_tags), endless)
                else:
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
                    at = end.end() if end else n
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                anchors = max(0, anchors + (-1 if m[1] else 1))
            elif tag in ("b", "strong"):
                bolds = max(0, bolds + (-1 if m[1] else 1))
            continue
        close()
        anchors = bolds = 0
        if m[1]:
            while tag in open_tags and leave() != tag:
                pass
        else:
            while stack and tag in CLOSES.get(stack[-1].tag, ()):
                leave()
            if tag not in VOID:
                words = tuple(w for a in ATTRIBUTE.finditer(m[3]) for w in PART.findall((a[2] or a[3] or a[4] or "").lower()))
                stack.append(Node(tag, words, stack[-1] if stack else None))
                open_tags[tag] = open_tags.get(tag, 0) + 1
    close()
    return out


class _Slots(dict):
    """Hash slot of each word seen, up to a bound."""

    def __init__(self, slots: int) -> None:
        super().__init__()
        self.slots = slots

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = slot = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"), seed=11) % self.slots
        return slot


_of_path, _of_word = _Slots(PATH_SLOTS), _Slots(WORD_SLOTS)


def vectors(blocks: list[Block], at_first: int = 0, of_page: int | None = None) -> np.ndarray:
    """blocks x FEATURES of a page, or of its blocks from ``at_first`` on if it has ``of_page``."""
    of_page = len(blocks) if of_page is None else of_page
    out = np.zeros((len(blocks), FEATURES), np.float32)
    flat: list[int] = []
    counts, shapes, paths = [], [], []
    last_path, last_slots = None, []
    for at, b in enumerate(blocks):
        if b.path is not last_path:
            last_path = b.path
            bits = b.path.slots | 1 << _of_path[">" + b.path.tag] if b.path else 0
            last_slots = np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(PATH_SLOTS // 8, "little"), np.uint8), bitorder="little")).tolist()
        paths += [at * FEATURES + k for k in last_slots]
        text = b.text
        words = text.lower().split(" ")
        n, size = len(words), len(text)
        flat += map(_of_word.__getitem__, words)
        counts.append(n)
        shapes.append(
            (min(size, 2000) / 500, math.log1p(size) / 5, min(n, 400) / 100, b.linked / size, b.bold / size, text.count(",") / n, text.count(".") / n,
             sum(map(text.count, "0123456789")) / size, text[-1] in ".!?", "©" in text, b.before, b.behind, 1 / (1 + at_first + at), 1 / (of_page - at_first - at), min(b.depth, 30) / 10, n <= 3)
        )
    if blocks:
        out.reshape(-1)[paths] = 1.0
        at = np.repeat(np.arange(len(blocks)), counts) * WORD_SLOTS + np.array(flat)
        found = np.bincount(at, minlength=len(blocks) * WORD_SLOTS).reshape(-1, WORD_SLOTS)
        out[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = found / np.array(counts)[:, None]
        out[:, PATH_SLOTS + WORD_SLOTS :] = np.array(shapes, np.float32)
    return out


class Page:
    """The vectors of a page's blocks, made slice by slice."""

    def __init__(self, blocks: list[Block]) -> None:
        self.blocks = blocks

    def __len__(self) -> int:
        return len(self.blocks)

    def __getitem__(self, part: slice) -> np.ndarray:
        return vectors(self.blocks[part], part.indices(len(self))[0], len(self))


class Labeller:
    """Bidirectional LSTM with one logistic output per block."""

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.w = {}
        for d in "fb":
            scale = 1 / np.sqrt(FEATURES / 8 + HIDDEN)
            self.w["x" + d] = rng.normal(0, scale, (FEATURES, 4 * HIDDEN)).astype(np.float32)
            self.w["h" + d] = rng.normal(0, scale, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.w["c" + d] = np.zeros(4 * HIDDEN, np.float32)
            self.w["c" + d][HIDDEN : 2 * HIDDEN] = 1.0  # forget gates begin open
        self.w["o"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)
        self.w["p"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, d: str, keep: bool, state: tuple[np.ndarray, np.ndarray] | None = None):
        """x: time x batch x FEATURES, already reversed for the backward direction.  ``state`` is (h, c) of the time before."""
        pre = x @ self.w["x" + d] + self.w["c" + d]
        h, c = state or (np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32))
        out = np.zeros((x.shape[0], x.shape[1], HIDDEN), np.float32)
        saved = []
        for t in range(x.shape[0]):
            z = pre[t] + h @ self.w["h" + d]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before = (h, c)
            c = f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[t] = h
            if keep:
                saved.append((before, i, f, o, g, th))
        return out, saved if keep else (h, c)

    @staticmethod
    def _flip(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each sequence reversed within its own length; padding stays behind."""
        t = np.arange(x.shape[0])[:, None]
        at = np.where(t < lengths, lengths - 1 - t, t)
        return x[at, np.arange(x.shape[1])[None, :]]

    def logits(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        f, _ = self._run(x, "f", False)
        b, _ = self._run(self._flip(x, lengths), "b", False)
        return np.concatenate([f, self._flip(b, lengths)], axis=2) @ self.w["o"] + self.w["p"]

    def gradients(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        xb = self._flip(x, lengths)
        f, sf = self._run(x, "f", True)
        b, sb = self._run(xb, "b", True)
        h = np.concatenate([f, self._flip(b, lengths)], axis=2)
        p = 1 / (1 + np.exp(-(h @ self.w["o"] + self.w["p"])))
        mask = np.arange(x.shape[0])[:, None] < lengths
        e = ((p - y) * mask / mask.sum()).astype(np.float32)
        grad = {"o": np.einsum("tb,tbh->h", e, h), "p": np.array([e.sum()], np.float32)}
        dh = e[:, :, None] * self.w["o"]
        for d, own, saved, up in (("f", x, sf, dh[:, :, :HIDDEN]), ("b", xb, sb, self._flip(dh[:, :, HIDDEN:], lengths))):
            dz = np.zeros((x.shape[0], x.shape[1], 4 * HIDDEN), np.float32)
            gh = np.zeros((HIDDEN, 4 * HIDDEN), np.float32)
            rest_h = rest_c = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t in range(x.shape[0] - 1, -1, -1):
                (h0, c0), i, fo, o, g, th = saved[t]
                dh_t = up[t] + rest_h
                dc = rest_c + dh_t * o * (1 - th * th)
                dz[t] = np.concatenate([dc * g * i * (1 - i), dc * c0 * fo * (1 - fo), dh_t * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                gh += h0.T @ dz[t]
                rest_h, rest_c = dz[t] @ self.w["h" + d].T, dc * fo
            grad["x" + d] = own.reshape(-1, FEATURES).T @ dz.reshape(-1, 4 * HIDDEN)
            grad["h" + d], grad["c" + d] = gh, dz.sum(axis=(0, 1))
        return grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = 32, rate: float = 0.01) -> None:
        rng = np.random.default_rng(SEED)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        step, mean = 0, {k: x.copy() for k, x in self.w.items()}
        for epoch in range(epochs):
            order = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i][1]) // 8)
            cuts = [order[a : a + batch] for a in range(0, len(order), batch)]
            for at in rng.permutation(len(cuts)):
                x, lengths = pad([pages[i][0] for i in cuts[at]])
                y, _ = pad([pages[i][1][:, None] for i in cuts[at]])
                step += 1
                for k, g in self.gradients(x, y[:, :, 0], lengths).items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = (self.w[k] - rate * 0.7**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
                    mean[k] += 0.02 * (self.w[k] - mean[k])
        self.w = mean

    def long_logits(self, page: Page | np.ndarray, run: int = RUN) -> np.ndarray:
        """One page in slices of ``run`` blocks, whose states go from slice to slice."""
        states = {}
        for d in "fb":
            out, state = np.zeros((len(page), HIDDEN), np.float32), None
            cuts = range(0, len(page), run)
            for a in cuts if d == "f" else reversed(cuts):
                step = 1 if d == "f" else -1
                h, state = self._run(page[a : a + run][::step, None, :], d, False, state)
                out[a : a + run] = h[::step, 0]
            states[d] = out
        return np.concatenate([states["f"], states["b"]], axis=1) @ self.w["o"] + self.w["p"]

    def label(self, pages: list[Page | np.ndarray]) -> list[np.ndarray]:
        """For each page's blocks: whether they are article."""
        out: list[np.ndarray] = [np.zeros(len(p), bool) for p in pages]
        batch: list[int] = []

        def flush() -> None:
            if batch:
                x, lengths = pad([pages[k][:] for k in batch])
                z = self.logits(x, lengths)
                for col, k in enumerate(batch):
                    out[k] = z[: lengths[col], col] > THRESHOLD
                batch.clear()

        for k in sorted((k for k, p in enumerate(pages) if len(p)), key=lambda k: len(pages[k])):
            if len(pages[k]) > RUN:
                out[k] = self.long_logits(pages[k]) > THRESHOLD
                continue
            if len(pages[k]) * (len(batch) + 1) > BATCH or len(batch) == 128:
                flush()
            batch.append(k)
        flush()
        return out


def pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    out = np.zeros((max(1, int(lengths.max())), len(rows), rows[0].shape[1]), np.float32)
    for k, r in enumerate(rows):
        out[: len(r), k] = r
    return out, lengths


# Training pages: what a template calls its parts.  Class words are drawn from these lists or are noise.
KINDS: dict[str, tuple[str, tuple[str, ...]]] = {
    "nav": ("nav div ul", ("nav", "menu", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs", "skip", "pagination", "pager", "toc", "tabs", "barre", "leiste", "indice")),
    "header": ("header div", ("header", "masthead", "topbar", "site", "brand", "logo", "banner", "tagline")),
    "footer": ("footer div", ("footer", "copyright", "legal", "bottom", "imprint", "colophon", "fuss", "impressum", "pied", "pie")),
    "aside": ("aside div section", ("sidebar", "aside", "widget", "related", "recommended", "popular", "trending", "archive", "tags", "also", "promo", "author", "bio", "social", "share")),
    "ad": ("div aside section ins p", ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "adsense", "promo", "banner", "outbrain", "taboola", "werbung", "anzeige", "publicite", "publicidad")),
    "notice": ("div section aside p", ("cookie", "notice", "consent", "gdpr", "alert", "popup", "modal", "privacy", "banner", "disclaimer", "warning", "message")),
    "form": ("form div", ("form", "newsletter", "subscribe", "signup", "login", "search", "contact")),
    "comments": ("section div ol ul", ("comments", "comment", "replies", "discussion", "responses", "disqus", "thread", "reader", "feedback", "kommentare", "commentaires", "comentarios")),
}
LAYOUT = ("row", "col", "container", "wrapper", "wrap", "inner", "outer", "grid", "layout", "page", "site", "box", "clearfix", "module", "block")
ARTICLE = ("article main div section", ("article", "post", "content", "entry", "story", "body", "main", "text", "news", "page", "blog", "single", "hentry", "inhalt", "artikel", "beitrag", "haupt", "contenu", "texte", "principal", "contenido", "articulo", "texto"))
SAID = {
    "nav": "Home About Contact News Sports Login Sitemap Products Services Blog Help".split(),
    "footer": ["All rights reserved", "Privacy policy", "Terms of use", "© 2024", "©"],
    "notice": ["We use cookies to improve your experience.", "Accept all", "This site uses cookies.", "Notice:", "Please read our privacy policy.", "By using this site you accept cookies."],
    "form": ["Subscribe", "Your email", "Search", "Sign up for our newsletter", "Get our newsletter by email", "Join our newsletter", "Name", "Submit", "Leave a reply"],
    "ad": ["Advertisement", "Sponsored", "Buy now", "Special offer", "Sponsored content"],
    "comments": ["Reply", "Great post!", "Comments", "says:", "2 days ago", "Like", "Nice one", "Thanks for sharing"],
    "aside": ["Related articles", "Most read", "Tags", "Follow us", "Share", "About the author", "Read more", "Share this story"],
    "header": ["Menu", "Daily News", "Search"],
}


class _Writer:
    def __init__(self, rng: random.Random) -> None:
        self.rng = rng
        parts = [a + b for a in "b c d f g l m n p r s t v w th sh st é ñ ü".split() for b in "a e i o u an er on es en".split()]
        self.syllables = rng.sample(parts, 40)

    def word(self) -> str:
        return "".join(self.rng.choice(self.syllables) for _ in range(self.rng.choice((1, 1, 2, 2, 3))))

    def words(self, n: int) -> str:
        out = []
        for _ in range(n):
            w = self.word()
            if not out or out[-1].endswith("."):
                w = w.capitalize()
            out.append(w + self.rng.choice(("", "", "", "", "", "", ",", ".")))
        return " ".join(out)

    def attrs(self, words: tuple[str, ...], known: float) -> str:
        r = self.rng
        own = [r.choice(words)] if r.random() < known else []
        own += [self.word() for _ in range(r.choice((0, 0, 0, 1)))]
        if not own:
            return ""
        joined = r.choice((" ", "-", "_")).join(own) + r.choice(("", "", "-inner", "-box", "-1"))
        return f' {r.choice(("class", "class", "class", "id"))}="{joined}"'

    def boiler(self, kind: str) -> list[tuple[str, str]]:
        """HTML pieces with the text of each block."""
        r = self.rng
        tags, words = KINDS[kind]
        tag = r.choice(tags.split()) if r.random() < 0.55 else tags.split()[0]
        plain = tag in ("div", "ul", "section", "p", "ins", "ol")
        out = [(f"<{tag}{self.attrs(words, 0.99 if plain else 0.5)}>", "")]
        if kind == "nav" or (kind in ("aside", "footer", "header") and r.random() < 0.5):
            items = [f"<li><a href=\"/{k}\">{self.word() if r.random() < 0.7 else r.choice(SAID[kind])}</a></li>" for k in range(r.randrange(1, 9))]
            joined = "".join(items)
            if tag != "ul" and r.random() < 0.3:
                joined = joined.replace("<li>", "").replace("</li>", r.choice((" ", " | ", "<br>")))
            elif tag != "ul":
                joined = f"<ul>{joined}</ul>"
            out.append((joined, "x"))
        elif kind == "comments":
            if r.random() < 0.5:
                level = r.choice(("h2", "h3", "h4"))
                out.append((f"<{level}>{r.choice(('Comments', '3 Comments', 'Discussion', 'Responses', self.word()))}</{level}>", "x"))
            for _ in range(r.randrange(1, 6)):
                said = self.words(r.randrange(2, 60)) if r.random() < 0.8 else r.choice(SAID[kind]) + " " + self.words(r.randrange(1, 9))
                inner = r.choice(("div", "li", "article", "", ""))
                if inner:
                    out.append((f"<{inner}{self.attrs(('comment', 'reply', 'user'), 0.5)}><p>{said}</p>", "x"))
                    if r.random() < 0.5:
                        out.append((f"<span>{r.choice(SAID[kind])}</span>", "x"))
                    out.append((f"</{inner}>", ""))
                else:
                    out.append((f"<p>{said}</p>", "x"))
        elif kind == "form":
            if r.random() < 0.75:
                inner = r.choice(("p", "p", "h3", "div"))
                out.append((f"<{inner}>{r.choice(SAID[kind])}</{inner}>", "x"))
            fields = f"<label>{r.choice(SAID[kind])}</label><input type=\"text\"><button>{r.choice(SAID[kind])}</button>"
            if tag != "form" and r.random() < 0.5:
                fields = f"<form><input><button>{r.choice((self.word(), 'Go', 'OK', 'Submit'))}</button></form>"
            out.append((fields, "x"))
            if r.random() < 0.5:
                out.append((f"<p>{self.words(r.randrange(3, 25))}</p>", "x"))
        else:
            for _ in range(r.choice((1, 1, 1, 2, 4))):
                text = r.choice(SAID[kind]) + " " if r.random() < 0.4 else ""
                body = text + self.words(r.randrange(2, 50))
                out.append((r.choice((body, f"<p>{body}</p>", f"<h3>{self.word()}</h3><p>{body}</p>", f"<p><a href=\"#\">{body}</a></p>")), "x"))
        out.append((f"</{tag}>", ""))
        return out

    def inline(self, text: str) -> str:
        """Some words of an article's text as links or marked."""
        r = self.rng
        words = text.split(" ")
        for _ in range(r.choice((0, 0, 0, 1, 1, 3))):
            at = r.randrange(len(words))
            tag = r.choice(("a", "a", "em", "strong", "code", "i", "span"))
            words[at] = f"<{tag}{' href=/x' if tag == 'a' else ''}>{words[at]}</{tag}>"
        return " ".join(words)

    def article(self, bare: bool, long: bool) -> tuple[str, str]:
        """The article up to its end, and the end tag.  ``bare``: with no class words, maybe with nothing around it."""
        r = self.rng
        tags, words = ARTICLE
        tag = r.choice(tags.split() + ["div", "", "", ""] if bare else tags.split())
        if r.random() < 0.25:  # in a language or a habit of its own
            words = (self.word(), self.word())
        out = [f"<{tag}{'' if bare else self.attrs(words, 0.9 if tag == 'div' else 0.4)}>"] if tag else []
        if bare and tag and r.random() < 0.3:
            out = [f"<{tag} id={self.word()}>"]
        if r.random() < 0.85:
            level = r.choice(("h1", "h1", "h2"))
            title = f"<{level}>{self.words(r.randrange(2, 14))}</{level}>"
            out.append(f"<header>{title}</header>" if r.random() < 0.1 else title)
        for _ in range(r.randrange(40, 160) if long else r.choice((1, 1, 2, 3, 4, 6, 9, 15))):
            kind = r.random()
            text = self.inline(self.words(r.choice((3, 8, 12) if long else (1, 3, 8, 20, 40, 80, 160))))
            if r.random() < 0.15:
                text = re.sub(r" ", lambda m: r.choice((" ", " ", "### ", "*** ", "&amp; ")), text)
            if kind < 0.72:
                out.append(f"<p>{text}" + r.choice(("</p>", "</p>", "", "<br>" + self.words(12) + "</p>")))
            elif kind < 0.8:
                out.append(f"<h2>{self.words(r.randrange(1, 7))}</h2>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{self.words(r.randrange(1, 15))}</li>" for _ in range(r.randrange(1, 6))) + "</ul>")
            elif kind < 0.91:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.95:
                out.append(
                    r.choice(
                        (
                            "<table>" + "".join(f"<tr><{c}>{self.words(r.randrange(1, 4))}</{c}><{c}>{self.words(r.randrange(1, 9))}</{c}></tr>" for c in r.choice((("td",), ("th", "td"), ("th", "td", "td", "td")))) + "</table>",
                            f"<pre>{text}</pre>",
                            f"<h3>{self.words(r.randrange(1, 6))}</h3>",
                            f"<ol><li>{self.words(3)}</li><li>{self.words(9)}</li></ol>",
                            f"<figure><img src='x'><figcaption>{self.words(r.randrange(2, 12))}</figcaption></figure>",
                            f"<dl><dt>{self.word()}</dt><dd>{self.words(6)}</dd></dl>",
                            f"<section><h2>{self.words(3)}</h2><p>{text}</p></section>",
                        )
                    )
                )
            elif kind < 0.98:
                out.append(f"<p><b>{text}<br><p>{self.words(30)}</p>")
            else:
                out.append(f"<div>{text}</div>")
        return "".join(out), f"</{tag}>" if tag else ""


MARK = "␂"


def training_page(rng: random.Random) -> tuple[str, list[bool]]:
    """A page and, for each of its blocks, whether it is article."""
    w = _Writer(rng)
    layout = rng.random()
    bare, lonely = layout < 0.25, layout < 0.12
    main, end = w.article(bare, rng.random() < 0.04)
    inner = [k for k in ("ad", "aside", "notice", "form") if rng.random() < 0.12]
    behind = [k for k in ("comments", "form", "aside") if rng.random() < 0.2] if end else []
    before = [k for k in ("notice", "header", "nav", "ad", "form", "aside") if rng.random() < 0.45]
    after = [k for k in ("comments", "aside", "ad", "form", "nav", "notice") if rng.random() < 0.3] + (["footer"] if rng.random() < 0.85 else [])
    if lonely:
        inner, behind, before, after = [], [], [], []
    if rng.random() < 0.4:
        rng.shuffle(before)
    pieces = [("<!DOCTYPE html><html><head><title>" + w.words(4) + "</title></head><body>", None)]

    def put(kinds: list[str]) -> None:
        for k in kinds:
            around = rng.random() < 0.15
            pieces.append((f"<div{w.attrs(LAYOUT, 0.8)}>" if around else "", None))
            pieces.extend((h, False) for h, _ in w.boiler(k))
            pieces.append(("</div>" if around else "", None))

    if rng.random() < 0.3 and not lonely:
        pieces.append((f"<div{w.attrs(LAYOUT, 0.8)}>", None))
    put(before)
    around = 0 if lonely else rng.choice((0, 0, 0, 1, 2))
    pieces += [(f"<div{w.attrs(LAYOUT, 0.8)}>", None)] * around
    cut = main.rfind("<p>") if inner else -1
    cut = cut if cut > 0 else len(main)
    pieces.append((main[:cut], True))
    put(inner)
    pieces.append((main[cut:], True))
    put(behind)
    pieces += [(end, None), ("</div>" * around, None)]
    put(after)
    page = "".join(re.sub(r">([^<])", lambda m: ">" + (MARK if keep else "") + m[1], h) if keep is not None else h for h, keep in pieces)
    return page, [MARK in b.text for b in scan(page)]


def training_set(pages: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = random.Random(seed)
    out = []
    for _ in range(pages):
        page, labels = training_page(rng)
        blocks = scan(page)
        for b in blocks:
            b.text = b.text.replace(MARK, "").strip() or "-"
        if blocks:
            out.append((vectors(blocks), np.array(labels, np.float32)))
    return out


@lru_cache(maxsize=1)
def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Labeller:
    model = Labeller(seed)
    model.fit(training_set(pages, seed))
    return model


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    scanned = [scan(p) for p in pages]
    filled = [b for b in scanned if b]
    labels = iter(model.label([Page(b) for b in filled]))
    return [" ".join(b.text for b, keep in zip(blocks, next(labels)) if keep) if blocks else "" for blocks in scanned]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Labeller | None = None) -> DataFrame:
    """id, url, text, n_chars of each row of ``pages``.  ``model`` is trained here if none is given."""
    model = model or trained()
    weights = {k: v.copy() for k, v in model.w.items()}

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        own = Labeller.__new__(Labeller)
        own.w = weights
        texts = main_texts(part.column(2).to_pylist(), own)
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return map_slices(pages, [id_col, url_col, html_col], html_col, run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars bigint")
