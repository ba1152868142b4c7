"""Operator 12, main-text extraction with a tree-structured graphical model.

A page is parsed into its block elements and text blocks, which form a tree.
Every node holds content or doesn't; a node's potential comes from its tag, its class,
id and role names, its text's length, punctuation and share of link text, an
edge's from the tags of parent and child.  Messages go from the leaves to the
root and back (sum-product, one depth of all pages of a slice at a time), which
gives each node's exact marginal; text blocks of probability 1/2 or more are the
page's text.

The potentials are learned by gradient ascent on the likelihood of labelled
pages: ``EXAMPLES`` generated ones (:mod:`html_examples`), and at most
``SAMPLE`` pages of the table of up to ``SAMPLE_CHARS`` characters that say
themselves where their content lies, by an ``article`` or ``main`` element.  The
sample is the pages of the least hashes, so the fit is bounded whatever the
table's size; every page is extracted whole.

Text: character references decoded as in HTML, white space (any Unicode white
space, ``br`` too) inside a block one space, blocks joined by an empty line.
Scripts, styles, templates, buttons and other parts that browsers don't set as
text are left out while parsing.

Edge cases: a null or empty page gives an empty text; a page without markup is
one block; tags cut off by the page's end are dropped, unclosed elements end with
their parent; repeated rows, ids and null ids each give their row; an empty table
gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import html as _html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm import html_examples
from sftforge.llm.common import documents, prepare, sliced

EXAMPLES, SAMPLE, SAMPLE_CHARS = 700, 200, 32_768
DIMS, EDGES = 1 << 14, 1 << 10
ROUNDS, RATE, PULL = 120, 0.4, 0.3

BLOCKS = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose text is no text of the page: those with raw contents, and those parsed like others.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
UNSET = frozenset("template svg select button object canvas video audio datalist math option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TRANSPARENT = frozenset("html head body".split())
#: A start tag that ends an open element of the same list, up to the bound.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
        "tfoot": ({"tbody", "thead", "tfoot"}, {"table"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^0-9A-Za-z]+")
_RAW_END = {t: re.compile(f"</{t}(?=[\\s/>])[^>]*(?:>|\\Z)|</{t}\\Z", re.I) for t in RAW}


class Page:
    """The tree of a page: per node its parent, depth, tag, attributes, and for text blocks the text."""

    def __init__(self, html: str):
        self.parent, self.depth, self.tag, self.attrs, self.text, self.linked = [-1], [0], ["#page"], [""], [None], [0]
        self._pieces: list[str] = []
        self._linked = 0
        self._open = [0]  # element nodes; -1: an element whose text isn't set
        self._names = ["#page"]
        self._unset = 0
        self._link_at = None
        at, end = 0, len(html)
        while at < end:
            m = TOKEN.search(html, at)
            if m is None:
                self._say(html[at:])
                break
            if m.start() > at:
                self._say(html[at:m.start()])
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                self._end(name)
            elif name in RAW:
                stop = _RAW_END[name].search(html, at)
                at = stop.end() if stop else end
            else:
                self._start(name, m.group(3))
        self._flush()

    def _say(self, raw: str) -> None:
        if self._unset:
            return
        text = _html.unescape(raw) if "&" in raw else raw
        self._pieces.append(text)
        if self._link_at is not None:
            self._linked += len(text)

    def _flush(self) -> None:
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                self._node("#text", "", text, min(self._linked, len(text)))
            self._pieces = []
        self._linked = 0

    def _node(self, tag: str, attrs: str, text: str | None, linked: int) -> int:
        up = next(x for x in reversed(self._open) if x >= 0) if self._open[-1] < 0 else self._open[-1]
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1

    def _pop(self, to: int) -> None:
        """Close elements until ``to`` are open."""
        self._flush()
        while len(self._open) > to:
            self._unset -= self._open.pop() < 0
            self._names.pop()
        if self._link_at is not None and self._link_at > to:
            self._link_at = None

    def _start(self, name: str, attrs: str) -> None:
        if name in TRANSPARENT:
            self.attrs[0] += attrs if name == "body" else ""
            return
        if name == "br":
            self._say(" ")
        elif name == "a":
            self._link_at = len(self._open)
        elif name in UNSET:
            if not attrs.rstrip().endswith("/"):
                self._flush()
                self._open.append(-1)
                self._names.append(name)
                self._unset += 1
        elif name in BLOCKS:
            self._flush()
            if name == "hr":
                return
            names = self._names
            if names[-1] == "p" or (name in HEADINGS and names[-1] in HEADINGS):
                self._pop(len(names) - 1)
            elif name in ENDS:
                closes, bound = ENDS[name]
                for i in range(len(names) - 1, 0, -1):
                    if names[i] in bound:
                        break
                    if names[i] in closes:
                        self._pop(i)
                        if name not in ("td", "th", "tr") or names[-1] not in closes:
                            break
            self._open.append(self._node(name, attrs, None, 0))
            self._names.append(name)

    def _end(self, name: str) -> None:
        if name == "a":
            self._link_at = None
        elif name == "br":
            self._say(" ")
        elif name in BLOCKS or name in UNSET:
            self._flush()
            same = HEADINGS if name in HEADINGS else (name,)
            for i in range(len(self._names) - 1, 0, -1):
                if self._names[i] in same:
                    self._pop(i)
                    break


# ---------------------------------------------------------------- features

def _dim(feature: str, size: int = DIMS) -> int:
    return zlib.crc32(feature.encode()) % size


_KNOWN: dict[str, tuple] = {}


def attribute_features(attrs: str) -> tuple[int, ...]:
    """Of the words in class, id, role and itemprop, and of being hidden."""
    known = _KNOWN.get(attrs)
    if known is None:
        out = []
        for name, value in ATTRIBUTE.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role", "itemprop"):
                out += [f"c:{w.lower()}" for w in CAMEL.split(value) if w] + [f"n:{w.lower()}" for w in value.split()]
            elif name == "hidden" or (name == "style" and "none" in value.lower() and "display" in value.lower()):
                out.append("hidden")
        known = tuple(sorted({_dim(x) for x in out}))
        if len(_KNOWN) > 20_000:
            _KNOWN.clear()
        if len(attrs) < 1000:
            _KNOWN[attrs] = known
    return known


def mark_of(attrs: str) -> int | None:
    m = re.search(r'data-y="([01])"', attrs)
    return int(m.group(1)) if m else None


def _share(part: int, whole: int) -> str:
    return "e" if not whole else str(min(4, int(5 * part / whole)))


class Batch:
    """Nodes of several pages side by side, with their features."""

    def __init__(self, pages: list[Page]):
        self.pages = pages
        parent, depth, where, feature, edge, first, n = [], [], [], [], [], [], 0
        for page in pages:
            first.append(n)
            size = [len(t) if t is not None else 0 for t in page.text]
            linked = list(page.linked)
            for i in range(len(size) - 1, 0, -1):
                size[page.parent[i]] += size[i]
                linked[page.parent[i]] += linked[i]
            leaves = [i for i, t in enumerate(page.text) if t is not None]
            around = dict(zip(leaves, zip([None, *leaves[:-1]], [*leaves[1:], None])))
            for i, (tag, text) in enumerate(zip(page.tag, page.text)):
                up = page.tag[page.parent[i]] if i else ""
                length, share = str(size[i].bit_length()), _share(linked[i], size[i])
                if text is None:
                    f = [_dim("t:" + tag), _dim("s:" + length), _dim("l:" + share), *attribute_features(page.attrs[i])]
                else:
                    near = [f"{k}:{'-' if j is None else min(8, len(page.text[j]).bit_length())}{_share(linked[j], size[j]) if j is not None else ''}"
                            for k, j in zip("ab", around[i])]
                    f = [_dim(x) for x in ("#", "p:" + up, "S:" + length, "L:" + share, "E" if text[-1] in ".!?…。" else "N",
                                           "C" if "," in text else "c", *near, *(["©"] if "©" in text else []),
                                           *(["sep"] if " | " in text or " · " in text else []), "w:" + str(min(6, text.count(" "))))]
                feature += f
                where += [n] * len(f)
                edge.append((_dim(f"{up}>{tag}", EDGES - 1) + 1) if i else 0)
                parent.append(page.parent[i] + first[-1] if i else -1)
                depth.append(page.depth[i])
                n += 1
        self.parent, self.depth = np.array(parent, np.int64), np.array(depth, np.int64)
        self.where, self.feature, self.edge = np.array(where, np.int64), np.array(feature, np.int64), np.array(edge, np.int64)
        self.first, self.n = first, n
        by = np.argsort(self.depth, kind="stable")
        self.levels = np.split(by, np.flatnonzero(np.diff(self.depth[by])) + 1) if n else []


class Model:
    """Weights of node features (for content) and of edges' (parent, child) values; edge 0 is common to all."""

    def __init__(self, node: np.ndarray, edge: np.ndarray):
        self.node, self.edge = node, edge

    def marginals(self, b: Batch) -> tuple[np.ndarray, np.ndarray]:
        """Each node's probability of content, and of every (parent, child) pair of values at its edge."""
        own = np.zeros((b.n, 2))
        own[:, 1] = np.bincount(b.where, self.node[b.feature], minlength=b.n)
        pair = self.edge[0] + np.where((b.edge > 0)[:, None, None], self.edge[b.edge], 0)
        up = np.zeros((b.n, 2))
        below = own.copy()
        for at in reversed(b.levels[1:]):  # from the leaves: what a subtree says of its parent's value
            up[at] = np.logaddexp.reduce(pair[at] + below[at][:, None, :], axis=2)
            np.add.at(below, b.parent[at], up[at])
        belief = below.copy()
        both = np.zeros((b.n, 2, 2))
        for at in b.levels[1:]:  # from the roots: what all else says of a node's value
            rest = belief[b.parent[at]] - up[at]
            joint = rest[:, :, None] + pair[at] + below[at][:, None, :]
            belief[at] = np.logaddexp.reduce(joint, axis=1)
            joint -= np.logaddexp.reduce(joint.reshape(len(at), 4), axis=1)[:, None, None]
            both[at] = np.exp(joint)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700))), both

    @classmethod
    def fitted(cls, pages: list[Page], labels: list[np.ndarray], rounds: int = ROUNDS) -> "Model":
        """Gradient ascent (step sizes by past gradients) on the pages' log likelihood, weights drawn to 0."""
        b = Batch(pages)
        y = np.concatenate(labels)
        model = cls(np.zeros(DIMS), np.zeros((EDGES, 2, 2)))
        child = np.flatnonzero(b.parent >= 0)
        told = np.zeros((b.n, 2, 2))
        told[child, y[b.parent[child]], y[child]] = 1
        seen_node, seen_edge = np.full(DIMS, 1e-8), np.full((EDGES, 2, 2), 1e-8)
        for _ in range(rounds):
            p, both = model.marginals(b)
            node = np.bincount(b.feature, (y - p)[b.where], minlength=DIMS) - PULL * model.node
            off = np.zeros((EDGES, 2, 2))
            np.add.at(off, b.edge[child], (told - both)[child])
            off[0] = (told - both)[child].sum(axis=0)
            off -= PULL * model.edge
            seen_node += node ** 2
            seen_edge += off ** 2
            model.node += RATE * node / np.sqrt(seen_node)
            model.edge += RATE * off / np.sqrt(seen_edge)
        return model


def node_labels(page: Page, own_mark) -> np.ndarray:
    """A text block's label is that of its nearest marked element; an element's whether it holds content."""
    mark, chars = [own_mark(page.tag[0], page.attrs[0]) or 0], np.zeros((len(page.tag), 2), np.int64)
    for i in range(1, len(page.tag)):
        m = own_mark(page.tag[i], page.attrs[i]) if page.text[i] is None else None
        mark.append(mark[page.parent[i]] if m is None else m)
    for i in range(len(page.tag) - 1, 0, -1):
        if page.text[i] is not None:
            chars[i, mark[i]] += len(page.text[i])
        chars[page.parent[i]] += chars[i]
    return (chars[:, 1] > 0).astype(np.int64)


_OTHER = frozenset(w for names in html_examples.NAMES.values() for n in names for w in CAMEL.split(n)) - {
    "page", "right", "col", "body", "list", "main", "site", "box", "message", "alert", "bottom", "links", "title", "text", "tools"}


def own_markup(tag: str, attrs: str) -> int | None:
    """What a page's own markup says: content in ``article`` and ``main``, none in parts named otherwise."""
    if tag in ("nav", "aside", "footer", "form", "dialog"):
        return 0
    for name, value in ATTRIBUTE.findall(attrs):
        if name.lower() in ("class", "id") and _OTHER & {w.lower() for w in CAMEL.split(value.strip("\"'"))}:
            return 0
    return 1 if tag in ("article", "main") else None


def labelled(pages: DataFrame, html_col: str, sample: int = SAMPLE, longest: int = SAMPLE_CHARS) -> list[str]:
    """At most ``sample`` distinct pages of up to ``longest`` characters with an ``article`` or ``main`` element."""
    html = F.col(html_col).cast("string")
    fit = (F.length(html) <= longest) & F.lower(html).rlike("<(article|main)[ >]")
    hashed = pages.select(F.when(fit, F.xxhash64(html)).alias("h"), F.when(fit, html).alias("html")).where(F.col("h").isNotNull())
    # First the least hashes alone, so that no task hands on more than numbers; then the pages that bear them.
    least = [r["h"] for r in hashed.groupBy("h").agg(F.count(F.lit(1))).orderBy("h").limit(sample).select("h").collect()]
    if not least:
        return []
    return [r["html"] for r in hashed.where(F.col("h") <= least[-1]).dropDuplicates(["h"]).orderBy("h").collect()]


def train(pages: DataFrame, html_col: str = "html", examples: int = EXAMPLES, sample: int = SAMPLE) -> Model:
    """The model fitted on the generated pages and on the table's own bounded sample."""
    made = [Page(h) for h in html_examples.pages(examples)]
    own = [Page(h) for h in labelled(pages, html_col, sample)] if sample else []
    return Model.fitted(made + own, [node_labels(p, lambda _, a: mark_of(a)) for p in made] + [node_labels(p, own_markup) for p in own])


def texts(htmls: list[str | None], model: Model) -> list[str]:
    pages = [Page(h or "") for h in htmls]
    b = Batch(pages)
    p, _ = model.marginals(b)
    return ["\n\n".join(t for i, t in enumerate(page.text) if t is not None and p[first + i] >= 0.5) for page, first in zip(pages, b.first)]


def extract(pages: DataFrame, model: Model, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, text and n_chars (code points) of every page."""
    spark = pages.sparkSession
    prepare(spark)
    weights = spark.sparkContext.broadcast((model.node, model.edge))  # of fixed size
    source = pages.select(*keep, F.col(html_col).cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*weights.value)
        for batch in sliced(batches, "_html"):
            out = texts(batch.column("_html").to_pylist(), own)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                             names=[*keep, "text", "n_chars"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(run, f"{schema}, text string, n_chars long")


def op12_tree_model_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages")
    return extract(pages, train(pages))
