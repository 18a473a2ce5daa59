"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node with a hidden label, content or not.  A node's own
potential comes from its tag, the words of its class, id and role, and its text (length,
share of links, sentence ends); a potential on each parent-child edge says how labels pass
down, apart for elements that tend to open a part of the page and for others.  Sum-product
messages run up and down the tree and give each node's marginal probability of content;
text whose element has a marginal of at least 0.5 is the result.

Weights are fitted by the gradient of the exact likelihood on labelled pages.  The tables
have no labels for elements, so the labelled pages are composed here, from parts whose label
is known (``labelled_pages``): articles in several kinds of containers, and menus, headers,
footers, sidebars, notices, adverts, forms and reader comments around and inside them.

Defined cases: a null, empty or blank page has an empty text; unclosed, misplaced and unknown
tags are read as browsers do in the simple cases (paragraphs, list items, table cells end
when the next one starts); a tag or quote that never ends takes the rest of the page with it;
text outside the body's blocks belongs to the body; rows that repeat an id are extracted each;
other columns are ignored."""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags as browsers' tokenizers read them: a quote opens a value only right after the equals
# sign, elsewhere it is a plain character; a tag ends at the first > outside such a value.  The
# quantifiers never give back, so odd markup takes no longer than clean markup.
_WS = r"\t\n\f\r "
_VALUE = rf"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^{_WS}>\"'][^{_WS}>]*+"
_NAMED = rf"([^{_WS}/>][^{_WS}/>=]*+)(?:[{_WS}]*+=[{_WS}]*+({_VALUE})?+)?+"
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^{_WS}/>]*+)((?:[{_WS}/]++|{_NAMED})*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(_NAMED, re.S)
_NAMING = {"class", "id", "role"}
_LETTERS = re.compile(r"[a-z]+")
_RAW = {t: re.compile(rf"</{t}(?=[{_WS}/>]|\Z)[^>]*+(?:>|\Z)", re.I) for t in
        ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")}

# Block elements of HTML.
BLOCKS = (
    "address article aside blockquote body button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre search section select summary table tbody td tfoot th thead "
    "tr ul head other"
).split()
_BLOCK = {t: i for i, t in enumerate(BLOCKS)}
# Elements without content of their own.
_VOID = {"hr"}
# An element of the key ends where one of the values starts, up to an element of the third.
_ENDS = {
    "p": {b for b in BLOCKS if b not in ("other",)},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"},
    "head": {"body"},
}
_FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"},
           "td": {"table"}, "th": {"table"}, "option": {"select"}}

# Words in class, id and role that pages use for their parts.
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs byline comment "
    "comments consent cookie cookies copyright disclaimer footer form gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notification pager pagination "
    "popup promo related search share sharing sidebar signup social sponsor sponsored subscribe "
    "tags toolbar widget discussion replies reply complementary contentinfo alert".split()
)
CONTENT_WORDS = frozenset(
    "article articlebody body content entry main maincontent page post story text".split()
)
_LENGTHS, _LINKS, _STOPS = (1, 25, 80, 200), (0.01, 0.3, 0.6), (1, 3)


def _feature_names() -> list[str]:
    return [
        "bias",
        *[f"tag_{t}" for t in BLOCKS],
        "aside_word",
        "content_word",
        *[f"length_{i}" for i in range(len(_LENGTHS) + 1)],
        *[f"links_{i}" for i in range(len(_LINKS) + 1)],
        *[f"stops_{i}" for i in range(len(_STOPS) + 1)],
    ]


FEATURES = {name: i for i, name in enumerate(_feature_names())}
_OPENERS = {_BLOCK[t] for t in "article aside body div footer form header main nav section".split()}


class Page:
    """Block elements in page order, and the runs of text between their borders."""

    def __init__(self, source: str):
        self.tag: list[int] = []
        self.words: list[str] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.marked: list[str] = []
        self.runs: list[tuple[int, str]] = []
        self.sizes: list[int] = []
        self.linked: list[int] = []
        self.stops: list[int] = []
        self._parse(source)

    def _open(self, tag: str, attributes: str) -> int:
        node = len(self.tag)
        self.tag.append(_BLOCK[tag])
        found = _ATTRIBUTE.findall(attributes) if attributes else ()
        self.words.append(" ".join(v for n, v in found if n.lower() in _NAMING).lower())
        self.marked.append(attributes)
        self.parent.append(self._stack[-1] if self._stack else -1)
        self.end.append(-1)
        for column in (self.sizes, self.linked, self.stops):
            column.append(0)
        self._stack.append(node)
        return node

    def _close(self, depth: int) -> None:
        """Close open elements down to ``depth``."""
        while len(self._stack) > depth:
            self.end[self._stack.pop()] = len(self.tag)

    def _flush(self) -> None:
        if not self._text:
            return
        pieces, self._text = self._text, []
        text = " ".join(html.unescape("".join(t for t, _ in pieces)).split())
        if not text:
            return
        node = self._stack[-1]
        size = sum(len(t) for t, _ in pieces) or 1
        linked = sum(len(t) for t, link in pieces if link)
        self.runs.append((node, text))
        self.sizes[node] += len(text)
        self.linked[node] += len(text) * linked // size
        self.stops[node] += text.count(". ") + text.count("! ") + text.count("? ") + (
            text[-1] in ".!?"
        )

    def _parse(self, source: str) -> None:
        self._stack: list[int] = []
        self._text: list[tuple[str, bool]] = []
        self._open("html", "")
        at, link = 0, 0
        while True:
            found = _TAG.search(source, at)
            text = source[at : found.start() if found else len(source)]
            if text:
                self._text.append((text, link > 0))
            if not found:
                break
            at = found.end()
            name = found.group(2)
            if name is None:
                continue
            name, closing = name.lower(), bool(found.group(1))
            if name in _RAW:
                if not closing:
                    over = _RAW[name].search(source, at)
                    at = over.end() if over else len(source)
            elif name == "br":
                self._text.append((" ", False))
            elif name == "a":
                link = max(0, link - 1) if closing else 1
            elif name == "html":
                continue
            elif name in _BLOCK and name != "other":
                self._flush()
                link = 0
                if closing:
                    self._end(name)
                else:
                    self._start(name, found.group(3))
        self._flush()
        self._close(0)

    def _start(self, name: str, attributes: str) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = BLOCKS[self.tag[self._stack[depth]]]
            if name in _ENDS.get(tag, ()):
                self._close(depth)
                if tag == "p":
                    continue
            if tag in _FENCES.get(name, ()):
                break
            if tag not in _ENDS and name not in _FENCES:
                break
        self._open(name, attributes)
        if name in _VOID:
            self._close(len(self._stack) - 1)

    def _end(self, name: str) -> None:
        fence = _FENCES.get(name, ())
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = BLOCKS[self.tag[self._stack[depth]]]
            if tag == name:
                self._close(depth)
                return
            if tag in fence:
                return


@lru_cache(100_000)
def _named(words: str) -> tuple[bool, bool]:
    found = _LETTERS.findall(words)
    joined = {a + b for a, b in zip(found, found[1:])}
    return not ASIDE_WORDS.isdisjoint(found), not CONTENT_WORDS.isdisjoint({*found, *joined})


@dataclass
class Trees:
    """The nodes of many pages, as arrays; parents come before children."""

    parent: np.ndarray
    kind: np.ndarray  # of the edge to the parent
    features: np.ndarray  # (nodes, used) feature numbers, -1 for none
    levels: list[np.ndarray]


def trees_of(pages: list[Page]) -> Trees:
    base = np.cumsum([0] + [len(p.tag) for p in pages])
    flat = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
    parent, end, tag = flat("parent"), flat("end"), flat("tag")
    shift = np.repeat(base[:-1], np.diff(base))
    parent = np.where(parent >= 0, parent + shift, -1)
    end = end + shift

    def inside(name: str) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(flat(name))])
        return upto[end] - upto[np.arange(len(end))]

    sizes, linked, stops = inside("sizes"), inside("linked"), inside("stops")
    named = np.array([_named(w) for p in pages for w in p.words], bool).reshape(-1, 2)
    features = np.column_stack(
        [
            np.zeros(len(tag), np.int64),
            1 + tag,
            np.where(named[:, 0], FEATURES["aside_word"], -1),
            np.where(named[:, 1], FEATURES["content_word"], -1),
            FEATURES["length_0"] + np.searchsorted(_LENGTHS, sizes, side="right"),
            FEATURES["links_0"]
            + np.searchsorted(_LINKS, linked / np.maximum(sizes, 1), side="right"),
            FEATURES["stops_0"] + np.searchsorted(_STOPS, stops, side="right"),
        ]
    )
    opens = np.isin(tag, list(_OPENERS)) | named.any(axis=1)
    depth = np.zeros(len(tag), np.int64)
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(1, (depth.max() if len(depth) else 0) + 1))
    return Trees(parent, opens.astype(np.int64), features, np.split(order, cuts))


def marginals(trees: Trees, weights: np.ndarray, edges: np.ndarray):
    """Sum-product on all trees at once, level by level.

    Returns each node's probability of content, the joint of each node (second index) with
    its parent (first), and the log partition sum of all trees."""
    n = len(trees.parent)
    padded = np.append(weights, 0.0)
    own = np.zeros((n, 2))
    own[:, 1] = padded[trees.features].sum(axis=1)
    up = own.copy()  # own potential and the children's messages
    message = np.zeros((n, 2))  # to the parent, by the parent's label
    for level in reversed(trees.levels[1:]):
        both = up[level][:, None, :] + edges[trees.kind[level]]
        message[level] = np.logaddexp(both[:, :, 0], both[:, :, 1])
        np.add.at(up, trees.parent[level], message[level])
    belief = np.zeros((n, 2))
    joint = np.zeros((n, 2, 2))
    total = 0.0
    for i, level in enumerate(trees.levels):
        if i == 0:
            belief[level] = up[level]
            total = float(np.logaddexp(up[level][:, 0], up[level][:, 1]).sum())
        else:
            outside = belief[trees.parent[level]] - message[level]
            both = outside[:, :, None] + edges[trees.kind[level]] + up[level][:, None, :]
            peak = both.max(axis=(1, 2), keepdims=True)
            part = np.exp(both - peak)
            joint[level] = part / part.sum(axis=(1, 2), keepdims=True)
            belief[level] = np.logaddexp(both[:, 0, :], both[:, 1, :])
    belief -= belief.max(axis=1, keepdims=True)
    shares = np.exp(belief)
    return shares[:, 1] / shares.sum(axis=1), joint, total


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    edges: np.ndarray  # (kind, parent's label, label)


def fit(pages: list[str], steps: int = 250, rate: float = 0.1) -> Model:
    """Likelihood fit on labelled pages: elements named data-y=1 are content, with all that
    is in them up to an element named data-y=0, and the other way round."""
    parsed = [Page(p) for p in pages]
    labels = []
    for page in parsed:
        own: list[int] = []
        for parent, attributes in zip(page.parent, page.marked):
            mark = re.search(r"data-y=(\d)", attributes or "")
            own.append(int(mark[1]) if mark else own[parent] if parent >= 0 else 0)
        labels += own
    y = np.array(labels)
    trees = trees_of(parsed)
    child = np.flatnonzero(trees.parent >= 0)
    seen_edges = np.zeros((2, 2, 2))
    np.add.at(seen_edges, (trees.kind[child], y[trees.parent[child]], y[child]), 1)

    def counts(share: np.ndarray) -> np.ndarray:
        out = np.zeros(len(FEATURES) + 1)
        np.add.at(out, trees.features, share[:, None])
        return out[:-1]

    seen = counts(y.astype(float))
    weights, edges = np.zeros(len(FEATURES)), np.zeros((2, 2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(edges),
               np.zeros_like(edges)]
    for step in range(1, steps + 1):
        share, joint, _ = marginals(trees, weights, edges)
        expected = np.zeros((2, 2, 2))
        np.add.at(expected, trees.kind[child], joint[child])
        grads = (seen - counts(share) - 0.1 * weights, seen_edges - expected - 0.1 * edges)
        for k, (value, grad) in enumerate(zip((weights, edges), grads)):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            value += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(weights, edges)


def labelled_pages(count: int = 400, seed: int = 5) -> list[str]:
    """Pages composed of parts with known labels, marked by data-y."""
    rng = random.Random(seed)
    stop = "."

    def words(a: int, b: int) -> str:
        return " ".join(
            "".join(rng.choice("aeioubdfglmnprst") for _ in range(rng.randint(2, 9)))
            for _ in range(rng.randint(a, b))
        )

    def sentences(a: int, b: int) -> str:
        return " ".join(words(3, 18).capitalize() + stop for _ in range(rng.randint(a, b)))

    def links(a: int, b: int, tag: str = "li") -> str:
        return "".join(
            f'<{tag}><a href="/x">{words(1, 4)}</a></{tag}>' for _ in range(rng.randint(a, b))
        )

    def named(tag: str, names: str) -> str:
        how = rng.choice(["class", "class", "id", "role"])
        return f'{tag} {how}="{rng.choice(names.split())}"'

    def aside() -> str:
        kind = rng.randrange(12)
        if kind == 0:
            return f"<nav data-y=0><ul>{links(3, 9)}</ul></nav>"
        if kind == 1:
            return f"<{named('div', 'menu navbar nav breadcrumbs')} data-y=0><ul>{links(2, 9)}</ul></div>"
        if kind == 2:
            return f"<header data-y=0><h1>{words(1, 4)}</h1><p>{words(2, 9)}</p></header>"
        if kind == 3:
            return f"<footer data-y=0>{sentences(1, 2)}</footer>"
        if kind == 4:
            return f"<{named('div', 'footer copyright disclaimer')} data-y=0><p>{sentences(1, 3)}</p></div>"
        if kind == 5:
            return f"<aside data-y=0><h3>{words(1, 3)}</h3><p>{sentences(1, 4)}</p><ul>{links(2, 5)}</ul></aside>"
        if kind == 6:
            return f"<{named('div', 'sidebar widget related promo')} data-y=0><h3>{words(1, 3)}</h3><p>{sentences(1, 4)}</p></div>"
        if kind == 7:
            return f"<{named('div', 'ad ads advert sponsored banner')} data-y=0>{sentences(1, 3)}</div>"
        if kind == 8:
            return f"<{named('div', 'cookie notice consent gdpr popup')} data-y=0><p>{sentences(1, 3)}</p><button>{words(1, 2)}</button></div>"
        if kind == 9:
            return f"<form data-y=0><p>{words(2, 8)}</p><select><option>{words(1, 2)}</option></select><button>{words(1, 2)}</button></form>"
        if kind == 10:
            part = "".join(f"<div class=comment><p>{sentences(1, 5)}</p></div>" for _ in range(rng.randint(1, 5)))
            return f"<{named('section', 'comments discussion replies')} data-y=0><h2>{words(1, 3)}</h2>{part}</section>"
        return f"<{named('div', 'share social newsletter subscribe')} data-y=0><p>{words(2, 12)}</p>{links(1, 4, 'div')}</div>"

    def block() -> str:
        kind = rng.randrange(12)
        if kind == 0:
            return f"<h2>{words(1, 7)}</h2>"
        if kind == 1:
            items = "".join(f"<li>{words(3, 15)}</li>" for _ in range(rng.randint(2, 6)))
            return f"<ul>{items}</ul>"
        if kind == 2:
            return f"<blockquote><p>{sentences(1, 3)}</p></blockquote>"
        if kind == 3:
            rows = "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr>" for _ in range(3))
            return f"<table><tbody>{rows}</tbody></table>"
        if kind == 4:
            return f"<pre>{words(3, 20)}</pre>"
        if kind == 5:
            return f"<p>{words(1, 2).capitalize()}.</p>"
        if kind == 6:
            return f"<figure><figcaption>{sentences(1, 1)}</figcaption></figure>"
        if kind == 7:
            return f"<div><p>{sentences(1, 5)}</p></div>"
        return f"<p>{sentences(1, 8)}</p>"

    pages = []
    for _ in range(count):
        # some pages are written without sentence ends
        stop = "." if rng.random() < 0.55 else rng.choice(["", " |", "***"])
        parts = [f"<h1>{words(2, 10)}</h1>"] * (rng.random() < 0.8)
        if rng.random() < 0.15:
            parts = [f"<header><h1>{words(2, 10)}</h1></header>"]
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            parts.append(block())
            if rng.random() < 0.07:
                parts.append(aside())
        body = "".join(parts)
        shape = rng.randrange(6)
        if shape <= 1:
            body = f"<article data-y=1>{body}</article>"
        elif shape == 2:
            body = f"<main data-y=1>{body}</main>"
        elif shape == 3:
            body = f"<{named('div', 'content main post entry article-body story')} data-y=1>{body}</div>"
        elif shape == 4:
            body = f"<main><article data-y=1>{body}</article>{aside()}</main>"
        else:
            body = f'<section class="post" data-y=1>{body}</section>'
        before = "".join(aside() for _ in range(rng.randint(0, 3)))
        after = "".join(aside() for _ in range(rng.randint(0, 3)))
        page = before + body + after
        if rng.random() < 0.5:
            page = f'<div class="{rng.choice(["container", "wrapper", "row", "page"])}">{page}</div>'
        pages.append(f"<html><head><title>{words(2, 5)}</title></head><body>{page}</body></html>")
    return pages


@lru_cache(1)
def default_model() -> Model:
    return fit(labelled_pages())


def main_texts(sources: list[str | None], model: Model) -> list[str]:
    """Main text of each page: blocks of content in page order, one to a line."""
    pages = [Page(s or "") for s in sources]
    share, _, _ = marginals(trees_of(pages), model.weights, model.edges)
    head, first, found = _BLOCK["head"], 0, []
    for page in pages:
        kept = share[first : first + len(page.tag)] >= 0.5
        first += len(page.tag)
        found.append(
            "\n".join(t for node, t in page.runs if kept[node] and page.tag[node] != head)
        )
    return found


def extract(pages: DataFrame, model: Model | None = None, most: int = 2 << 20) -> DataFrame:
    """page_id, url, text, n_chars of every page; ``most``: bytes of pages that a task
    works on at a time, whole pages each."""
    model = model or default_model()

    def read(batches):
        for batch in batches:
            sources = batch.column(2).to_pylist()
            texts, held, size = [], [], 0
            for source in sources:
                held.append(source)
                size += len(source or "")
                if size >= most:
                    texts += main_texts(held, model)
                    held, size = [], 0
            texts += main_texts(held, model) if held else []
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        read, "page_id long, url string, text string, n_chars long"
    )
