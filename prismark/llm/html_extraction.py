"""Operator 4: main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: runs of text between block-level tags,
scripts, styles and comments left out.  A block is a vector of its tag path
(tags, classes and ids, hashed and randomly projected), of its words (hashed
and projected) and of a few lengths and densities.  A bidirectional LSTM in
numpy reads the blocks of the whole page in order and gives every block the
probability of being main text, so each decision has the whole document for
context.

The network is trained here, on a bounded sample of about ``sample_pages`` pages:
blocks inside an article or main element are positive, blocks in menus,
headers, footers, asides, forms and the like negative.  Every sample page is also
rebuilt with other containers (and reader comments, notices and sidebars
around its own texts), so that the labeller does not hang on one site's tags.

Defined cases: null and empty pages, and pages without main text, give an
empty text; unclosed tags end with their parent; scripts, styles and other raw
elements reach to their own end tag, whatever is in them; buttons, drawings and other
hidden elements without an end tag reach to the next paragraph, list, container or the like, or
to the end of their parent; ``>`` in a quoted attribute value ends no tag; the first tag or text
that cannot be in a head ends it; a page of any length is read whole; pages with equal content give equal texts; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# HTML elements whose text flows on with its surroundings.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# HTML elements that never have an end tag, and elements whose content is not shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template svg math iframe object title select textarea button canvas".split())
# HTML elements without text that leave a head open.
IN_HEAD = frozenset("html head meta link base basefont bgsound".split())
# Names by which training blocks are told.
MAIN_NAMES = ("article", "main", "post", "content", "entry", "story")
OTHER_NAMES = (
    "nav", "header", "footer", "aside", "form", "menu", "ad", "ads", "advert", "sidebar", "cookie", "notice", "banner",
    "comments", "comment", "related", "share", "social", "promo", "breadcrumb", "subscribe", "newsletter", "widget",
)
# HTML elements that are never part of a control or a drawing; they end one without an end tag.
FLOW = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split()
)
# Hidden elements that cannot hold themselves.
UNNESTED = frozenset("select button noscript canvas".split())
# Attributes up to the end of a tag, which is no sign inside a quoted value.
ATTRIBUTES = r"""(?:[^>=]|=(?:\s*+(?:"[^"]*"|'[^']*'))?+)*+"""
# The content of raw elements is no markup: it reaches to their own end tag.
TOKENS = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>(?i:script|style|textarea|title|iframe))(?=[\s/>])" + ATTRIBUTES + r"(?<!/)>.*?(?:</(?i:(?P=raw))(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)(" + ATTRIBUTES + r")(?:>|\Z)|([^<]+|<)",
    re.S,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[^\W_]+")

PATH_DIMS, WORD_DIMS, EXTRA = 48, 16, 7
DIMS = PATH_DIMS + WORD_DIMS + EXTRA


def hidden_ends(tokens) -> dict[int, int]:
    """Position of the end tag of every hidden element that has one, by the position of its start tag."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for k, m in enumerate(tokens):
        name = (m.group(3) or "").lower()
        if name not in HIDDEN:
            continue
        held = opened.setdefault(name, [])
        if m.group(2):
            if held:
                found[held.pop()] = k
        elif not m.group(4).rstrip().endswith("/"):
            if name in UNNESTED:
                held.clear()
            held.append(k)
    return found


def leaf_blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """``(tag path, text, share of characters in links)`` of every leaf block, in page order."""
    blocks: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link, path = 0, 0, ()
    hidden, in_head = False, False

    def close_block():
        nonlocal parts, linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                blocks.append((path, text, min(1.0, linked / len(text))))
            parts, linked = [], 0

    tokens = list(TOKENS.finditer(page))
    ends, after = hidden_ends(tokens), 0
    for at, m in enumerate(tokens):
        if at < after:
            continue
        raw, end, tag, rest, text = m.groups()
        if hidden:  # in an element without an end tag: up to flow content or the end of what it is in
            name = (tag or "").lower()
            if end:
                hidden = not (name == "head" if in_head else any(name == held for held, _ in stack))
            else:
                hidden = name not in FLOW and name not in HIDDEN
            if hidden:
                continue
        if raw:
            close_block()
            in_link = 0
            continue
        if in_head:
            name = (tag or "").lower()
            if end and name not in ("body", "html", "br"):
                in_head = name != "head"
                continue
            if name in IN_HEAD and not end or not tag and not (text or "").strip():
                continue
            in_head = name in HIDDEN
        if text is not None:
            parts.append(text)
            if in_link:
                linked += len(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = 0 if end else 1
            continue
        close_block()
        in_link = 0
        if end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag == "head":
            in_head = True
        elif tag in HIDDEN:
            if at in ends:
                after = ends[at] + 1
            else:
                hidden = not rest.rstrip().endswith("/")
        elif tag not in VOID and not rest.rstrip().endswith("/"):
            if stack and stack[-1][0] == tag and tag in ("p", "li", "td", "tr", "dt", "dd", "option"):
                stack.pop()
            elif tag == "p" and len(stack) > 1 and stack[-1][0] in ("h1", "h2", "h3"):
                stack.pop()
            names = [n.lower() for g in NAMES.findall(rest) for n in re.split(r"[^A-Za-z]+", "".join(g)) if n]
            stack.append((tag, (tag, *names)))
        path = tuple(n for _, names in stack for n in names)
    close_block()
    return blocks


def weak_label(path: tuple[str, ...]) -> int | None:
    """1 in an article, 0 in a container of other things, None where the markup does not tell."""
    for name in reversed(path):
        if name in OTHER_NAMES:
            return 0
        if name in MAIN_NAMES:
            return 1
    return None


def _projection(token: str, dims: int) -> np.ndarray:
    rng = np.random.default_rng(zlib.crc32(token.encode("utf-8", "surrogatepass")))
    return rng.standard_normal(dims).astype(np.float32)


class Vectors:
    """Block vectors; projections of path names and word hashes are remembered."""

    def __init__(self, word_buckets: int = 1024):
        self.names: dict[str, np.ndarray] = {}
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words = np.random.default_rng(7).standard_normal((word_buckets, WORD_DIMS)).astype(np.float32)

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 50_000:
                self.paths.clear()
            v = np.zeros(PATH_DIMS, np.float32)
            for depth, name in enumerate(reversed(path[-24:])):
                if name not in self.names:
                    if len(self.names) > 50_000:
                        self.names.clear()
                    self.names[name] = _projection(name, PATH_DIMS)
                v += self.names[name] * (0.9**depth)
            self.paths[path] = v / 2
        return self.paths[path]

    def page(self, blocks) -> np.ndarray:
        out = np.zeros((len(blocks), DIMS), np.float32)
        n = max(len(blocks), 1)
        for k, (path, text, links) in enumerate(blocks):
            words = WORDS.findall(text)
            out[k, :PATH_DIMS] = self.path(path)
            if words:
                hashed = [zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % len(self.words) for w in words]
                out[k, PATH_DIMS : PATH_DIMS + WORD_DIMS] = self.words[hashed].mean(axis=0)
            out[k, PATH_DIMS + WORD_DIMS :] = (
                np.log1p(len(text)) / 4, np.log1p(len(words)) / 3, links, k / n,
                sum(text.count(c) for c in ".,;:!?") / max(len(words), 1), 1.0 if text[-1:] in ".!?" else 0.0,
                min(len(path), 24) / 8,
            )
        return out


class BiLstm:
    """Two LSTMs over a padded batch of pages, and a logistic unit per block."""

    def __init__(self, hidden: int = 16, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.w: dict[str, np.ndarray] = {}
        for d in ("f", "b"):
            self.w["x" + d] = (rng.standard_normal((DIMS, 4 * hidden)) / np.sqrt(DIMS)).astype(np.float32)
            self.w["h" + d] = (rng.standard_normal((hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1.0  # remember at first
            self.w["g" + d] = bias
        self.w["o"] = (rng.standard_normal((2 * hidden, 1)) / np.sqrt(2 * hidden)).astype(np.float32)
        self.w["c"] = np.zeros(1, np.float32)

    @staticmethod
    def _sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def _run(self, x, mask, d, keep):
        h, n = self.h, x.shape[1]
        a = x @ self.w["x" + d] + self.w["g" + d]
        s, c = (np.zeros((x.shape[0], h), np.float32) for _ in range(2))
        out = np.zeros((*x.shape[:2], h), np.float32)
        steps = []
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            z = a[:, t] + s @ self.w["h" + d]
            i, f, o = (self._sigmoid(z[:, k * h : (k + 1) * h]) for k in range(3))
            g = np.tanh(z[:, 3 * h :])
            c2 = f * c + i * g
            tc = np.tanh(c2)
            m = mask[:, t, None]
            if keep:
                steps.append((t, s, c, i, f, o, g, tc))
            s, c = m * (o * tc) + (1 - m) * s, m * c2 + (1 - m) * c
            out[:, t] = s
        return out, steps

    def forward(self, x, mask, keep=False):
        f, fs = self._run(x, mask, "f", keep)
        b, bs = self._run(x, mask, "b", keep)
        both = np.concatenate((f, b), axis=2)
        return self._sigmoid((both @ self.w["o"])[..., 0] + self.w["c"]), both, (fs, bs)

    def gradients(self, x, mask, y, weight):
        p, both, (fs, bs) = self.forward(x, mask, keep=True)
        dz = ((p - y) * weight / max(weight.sum(), 1))[..., None].astype(np.float32)
        grad = {"o": np.einsum("ntk,ntu->ku", both, dz), "c": dz.sum(axis=(0, 1))}
        dout = dz @ self.w["o"].T
        h = self.h
        for d, steps, part in (("f", fs, dout[..., :h]), ("b", bs, dout[..., h:])):
            da = np.zeros((*x.shape[:2], 4 * h), np.float32)
            gh = np.zeros_like(self.w["h" + d])
            ds, dc = (np.zeros((x.shape[0], h), np.float32) for _ in range(2))
            for t, s, c, i, f, o, g, tc in reversed(steps):
                m = mask[:, t, None]
                ds = ds + part[:, t]
                dcell = m * (dc + ds * o * (1 - tc * tc))
                dzt = np.concatenate(
                    (dcell * g * i * (1 - i), dcell * c * f * (1 - f), m * ds * tc * o * (1 - o), dcell * i * (1 - g * g)), axis=1
                )
                da[:, t] = dzt
                gh += s.T @ dzt
                ds = dzt @ self.w["h" + d].T + (1 - m) * ds
                dc = dcell * f + (1 - m) * dc
            grad["x" + d] = np.einsum("ntk,ntu->ku", x, da, optimize=True)
            grad["h" + d] = gh
            grad["g" + d] = da.sum(axis=(0, 1))
        return grad

    def train(self, pages, epochs: int, rate: float = 0.01, batch: int = 32, seed: int = 3) -> None:
        """``pages``: (vectors, labels, weights) of every page; Adam."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), batch):
                part = [pages[k] for k in order[at : at + batch]]
                x, mask = pad([p[0] for p in part])
                y, weight = (np.zeros(mask.shape, np.float32) for _ in range(2))
                for k, (v, label, w) in enumerate(part):
                    y[k, : len(v)], weight[k, : len(v)] = label, w
                step += 1
                for k, g in self.gradients(x, mask, y, weight).items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def label(self, pages: list[np.ndarray], cells: int = 1 << 15) -> list[np.ndarray]:
        """Main-text probability of every block; pages of like length run together, ``cells`` bounds a batch."""
        out: list = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            n = len(pages[order[-1]])
            take = order[-max(1, cells // n) :]
            del order[-len(take) :]
            x, mask = pad([pages[k] for k in take])
            p = self.forward(x, mask)[0]
            for row, k in zip(p, take):
                out[k] = row[: len(pages[k])]
        return out


def pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = max(map(len, pages))
    x = np.zeros((len(pages), n, DIMS), np.float32)
    mask = np.zeros((len(pages), n), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
        mask[k, : len(p)] = 1
    return x, mask


def rebuilt(blocks, labels, rng) -> tuple[list, list[int]]:
    """The page with other containers around its own texts, and the labels of its blocks."""
    main = [b[1] for b, k in zip(blocks, labels) if k == 1]
    words = [w for t in main for w in t.split()] or ["a"]

    def some(low, high):
        at = int(rng.integers(0, len(words)))
        return " ".join(words[at : at + int(rng.integers(low, high))]) or words[0]

    def pick(*options):
        return tuple(options[int(rng.integers(0, len(options)))].split())

    out, told = [], []

    def add(path, text, links=0.0, label=0):
        out.append((("html", "body", *path), text, links))
        told.append(label)

    def other(where):
        kind = int(rng.integers(0, 8))
        if kind == 0:
            box = pick("nav", "div menu", "header nav", "ul menu", "div breadcrumb")
            for _ in range(int(rng.integers(2, 8))):
                add((*box, "ul", "li"), some(1, 3), 1.0)
        elif kind == 1:
            box = pick("aside", "div sidebar", "aside widget", "section related", "div promo")
            add((*box, "h"  + str(int(rng.integers(2, 5)))), some(1, 4))
            for _ in range(int(rng.integers(1, 5))):
                add((*box, *pick("p", "li", "div")), some(3, 25), float(rng.integers(0, 2)))
        elif kind == 2:
            add(pick("div ad", "div ads", "div advert", "section banner", "aside ad", "div sponsored"), some(2, 30), float(rng.integers(0, 2)))
        elif kind == 3:
            add((*pick("div cookie", "div notice", "div banner", "section notice cookie", "div alert"), *pick("p", "span", "div")), some(4, 25))
        elif kind == 4:
            box = pick("form", "div subscribe form", "form newsletter", "form search")
            add((*box, *pick("p", "div", "fieldset", "legend")), some(1, 10))
        elif kind == 5 and where == "after":
            box = pick("section comments", "div comments", "ol comments", "div comment list", "section responses")
            for _ in range(int(rng.integers(1, 7))):
                add((*box, *pick("div comment", "li comment", "article comment", "div comment body"), *pick("p", "div")), some(4, 60))
        elif kind == 6 or where == "after":
            box = pick("footer", "div footer", "footer site")
            add(box, "© " + some(2, 12), float(rng.integers(0, 2)))
        else:
            add((*pick("header", "div header", "header masthead"), *pick("div", "p", "h1", "span")), some(1, 6), float(rng.integers(0, 2)))

    for _ in range(int(rng.integers(1, 4))):
        other("before")
    box = pick("article", "main", "main article", "div content", "div post content", "div entry content", "div article body", "section article")
    for k, text in enumerate(main):
        tail = ("h1",) if k == 0 and rng.random() < 0.5 else pick("p", "p", "p", "p", "h2", "li", "blockquote", "td", "div")
        add((*box, *tail), text, 0.0, 1)
        if rng.random() < 0.04:
            add((*box, *pick("div ad", "aside", "div share", "aside related"), *pick("p", "div")), some(2, 15))
    for _ in range(int(rng.integers(1, 4))):
        other("after")
    return out, told


def train_labeller(
    pages: DataFrame, sample_pages: int = 200, variants: int = 4, epochs: int = 12, most_blocks: int = 80,
    id_col: str = "page_id", html_col: str = "html",
) -> BiLstm:
    """The labeller trained on about ``sample_pages`` pages and ``variants`` rebuilt pages of each.

    Sample pages are taken by a hash of their id; of a longer page the first
    ``most_blocks`` blocks are used in training (never in labelling).
    """
    n = pages.count()
    rate = min(1.0, sample_pages / max(n, 1))
    dice = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_003)) / 1_000_003
    sample = pages.where((dice < rate) & F.col(html_col).isNotNull()).select(F.substring(html_col, 1, 60_000).alias("h"))
    rows = sorted(r["h"] for r in sample.limit(2 * sample_pages).collect())
    vectors, rng, made = Vectors(), np.random.default_rng(5), []
    for page in rows:
        blocks = leaf_blocks(page)[:most_blocks]
        told = [weak_label(b[0]) for b in blocks]
        known = [k is not None for k in told]
        if any(known):
            made.append((vectors.page(blocks), [k or 0 for k in told], np.array(known, np.float32)))
        main = [k if k is not None else int(len(b[1]) > 80) for b, k in zip(blocks, told)]
        if any(main):
            for _ in range(variants):
                other, labels = rebuilt(blocks, main, rng)
                made.append((vectors.page(other[: 2 * most_blocks]), labels[: 2 * most_blocks], np.ones(len(labels[: 2 * most_blocks]), np.float32)))
    model = BiLstm()
    if made:
        model.train(made, epochs)
    return model


def extract(
    pages: DataFrame, model: BiLstm, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """``page_id, url, text, n_chars``: the blocks labelled main text, joined by line breaks."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([
        StructField("page_id", pages.schema[id_col].dataType), StructField("url", pages.schema[url_col].dataType),
        StructField("text", StringType()), StructField("n_chars", LongType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        import pyarrow as pa

        vectors = Vectors()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                blocks = [leaf_blocks(p or "") for p in part.column(2).to_pylist()]
                told = model.label([vectors.page(b) for b in blocks])
                texts = ["\n".join(b[1] for b, p in zip(bs, ps) if p >= threshold) for bs, ps in zip(blocks, told)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(arrow.field(0).type), part.column(1).cast(arrow.field(1).type),
                        pa.array(texts, arrow.field(2).type), pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=arrow.names,
                )

    return pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    ).mapInArrow(run, schema)
