"""Main-text extraction from web pages with a tree-structured graphical model.

Every DOM node is content or boilerplate. Node potentials come from what the node shows (kind of tag, amount of text,
share of link text, sentence marks), edge potentials from how parents and children agree; both are learned from
labelled pages. One sum-product pass up the tree and one down give each node's marginal; text nodes whose marginal
reaches one half make the extracted text. The nodes of many pages are handled level by level in whole-array steps.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.plans.runtime import small_batches, spread

TRAIN_PAGES = 2000
BATCH_CHARS = 4 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
BLOCK = frozenset("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
#: Tags that say which part of a page is content: they label training pages and look like ``div`` to the model.
CONTENT_MARKS = frozenset(("article", "main"))
BOILERPLATE_MARKS = frozenset(("nav", "footer", "aside", "header", "form"))
#: An open tag of these is closed by a new one of the same group.
CLOSES = {"p": BLOCK - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

KINDS = {t: k for k, tags in enumerate((("#text",), ("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl"), ("li", "dt", "dd"), ("a",), ("table", "tr", "td", "th", "tbody", "thead", "tfoot"), ("blockquote", "pre", "code"), ("b", "i", "em", "strong", "span", "u", "small", "sup", "sub", "font"), ("form", "button", "label", "select", "option"), ("html", "body"))) for t in tags}
N_KINDS = 12
N_LENGTH, N_LINKS, N_MARKS = 7, 4, 3
SHAPE = (N_KINDS, N_LENGTH, N_LINKS, N_MARKS)

RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_nodes", T.IntegerType()), T.StructField("n_kept", T.IntegerType()), T.StructField("certainty", T.DoubleType())])

#: An open tag is closed by a new one only above the innermost of these.
SCOPES = frozenset(("table", "ul", "ol", "dl", "article", "section", "div", "body"))
#: Deeper nodes hang from the last ancestor within the limit, as browsers have it; their text stays.
MAX_NESTING = 512

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_SENTENCE = re.compile(r"[.!?…。]")


class Tree:
    """Nodes of one page in document order: parent index, tag and, for text nodes, the text."""

    __slots__ = ("parent", "tag", "text", "label")

    def __init__(self):
        self.parent, self.tag, self.text, self.label = [-1], ["#root"], [None], [0]

    def add(self, parent: int, tag: str, text: str | None, label: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.text.append(text)
        self.label.append(label)
        return len(self.parent) - 1


def parse(page: str | None) -> Tree:
    """DOM of a page, however broken: comments and raw-text elements hold nothing, end tags without a start are ignored.

    ``label`` is 1 inside CONTENT_MARKS, -1 in a page part outside them, 0 where a page has no such marks.
    """
    tree = Tree()
    page = page or ""
    stack, mark = [(0, "#root", -1)], -1
    open_tags: dict[str, list[int]] = {}  # the places in the stack of each tag
    scopes = [0]
    at, n, quotes = 0, len(page), True

    def parent() -> int:
        return stack[min(len(stack), MAX_NESTING) - 1][0]

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            tree.add(parent(), "#text", entities.unescape(piece) if "&" in piece else piece, mark)

    def pop() -> None:
        nonlocal mark
        _, name, mark = stack.pop()
        open_tags[name].pop()
        if name in SCOPES:
            scopes.pop()

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        if page.startswith("<!--", lt):
            text(page[at:lt])
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        m = _TAG.match(page, lt)
        if m is None:
            if page.startswith(("<!", "<?"), lt):
                text(page[at:lt])
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:  # a lone less-than sign is text
                end = page.find("<", lt + 1)
                end = n if end < 0 else end
                text(page[at:end])
                at = end
            continue
        text(page[at:lt])
        end = page.find(">", m.end())
        if end < 0:
            break
        odd = page.count('"', m.end(), end) % 2
        while quotes and odd:  # the sign stood in a quoted value
            close = page.find('"', end)
            after = page.find(">", close) if close >= 0 else -1
            if after < 0:
                quotes = False
                break
            odd = (odd + page.count('"', end, after)) % 2
            end = after
        name = m.group(2).lower()
        at = end + 1
        if m.group(1):
            if open_tags.get(name):
                while stack[-1][1] != name:
                    pop()
                pop()
            continue
        if name in RAW:
            if page[end - 1] != "/":
                close = re.compile(f"</{name}", re.IGNORECASE).search(page, at)
                gt = page.find(">", close.end()) if close else -1
                at = gt + 1 if gt >= 0 else n
            continue
        for opened, closers in CLOSES.items():
            places = open_tags.get(opened)
            if places and name in closers and places[-1] > scopes[-1]:
                depth = places[-1]
                while len(stack) > depth:
                    pop()
        now = 1 if name in CONTENT_MARKS else -1 if name in BOILERPLATE_MARKS else mark
        node = tree.add(parent(), name, None, now)
        if name not in VOID and page[end - 1] != "/":
            open_tags.setdefault(name, []).append(len(stack))
            if name in SCOPES:
                scopes.append(len(stack))
            stack.append((node, name, mark))
            mark = now
    if 1 not in tree.label:
        tree.label = [0] * len(tree.label)
    return tree


class Forest:
    """The trees of many pages end to end, with features and levels."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.parent) for t in trees]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        n = int(self.starts[-1])
        parent = np.concatenate([np.array(t.parent, np.int64) + s for t, s in zip(trees, self.starts)]) if trees else np.zeros(0, np.int64)
        roots = self.starts[:-1]
        parent[roots] = roots
        self.parent = parent
        tags = [x for t in trees for x in t.tag]
        texts = [x for t in trees for x in t.text]
        self.label = np.array([x for t in trees for x in t.label], np.int8)
        self.leaf = np.array([x is not None for x in texts], bool)
        level, flat = [0] * n, parent.tolist()
        for k in range(n):
            if flat[k] != k:
                level[k] = level[flat[k]] + 1
        self.levels = _by_level(np.array(level, np.int32))
        chars = np.array([len(x) if x else 0 for x in texts], np.int64)
        marks = np.array([len(_SENTENCE.findall(x)) if x else 0 for x in texts], np.int64)
        link = np.array([t == "a" for t in tags], bool)
        for rows in self.levels:
            link[rows] |= link[parent[rows]]
        linked = np.where(link, chars, 0)
        for rows in reversed(self.levels):
            for sums in (chars, marks, linked):
                np.add.at(sums, parent[rows], sums[rows])
        kind = np.array([KINDS.get(t, N_KINDS - 1) for t in tags], np.int64)
        length = np.minimum(np.log2(np.maximum(chars, 1) / 8).clip(0).astype(np.int64), N_LENGTH - 1)
        share = linked / np.maximum(chars, 1)
        links = (share > 0).astype(np.int64) + (share > 0.25) + (share > 0.75)
        density = marks / np.maximum(chars, 1) * 100
        self.kind, self.chars = kind, chars
        self.cell = np.ravel_multi_index((kind, length, links, (density > 0.2).astype(np.int64) + (density > 1.0)), SHAPE) if n else np.zeros(0, np.int64)


def _by_level(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(1, int(depth.max(initial=0)) + 2))
    return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


class Model:
    """Log potentials: ``node`` by feature cell and label, ``edge`` by the child's kind, parent's and child's label."""

    def __init__(self, node: np.ndarray, edge: np.ndarray, root: np.ndarray):
        self.node, self.edge, self.root = node, edge, root

    @classmethod
    def from_counts(cls, node: np.ndarray, edge: np.ndarray, root: np.ndarray, smooth: float = 0.5) -> Model:
        # sparse cells lean on each feature by itself
        full = node.reshape(*SHAPE, 2)
        alone = np.zeros((*SHAPE, 2))
        for axis in range(4):
            other = tuple(k for k in range(4) if k != axis)
            m = full.sum(axis=other) + smooth
            m = m / m.sum(0)
            alone += np.log(m).reshape([SHAPE[k] if k == axis else 1 for k in range(4)] + [2])
        alone = np.exp(alone).reshape(-1, 2)
        weight = 20.0
        p = node + weight * alone / np.maximum(alone.sum(0), 1e-300)
        p = p / p.sum(0)
        e = edge + smooth
        r = root + smooth
        return cls(np.log(p), np.log(e / e.sum(2, keepdims=True)), np.log(r / r.sum()))


def marginals(f: Forest, model: Model) -> np.ndarray:
    """P(content) of every node by sum-product: collect messages from the leaves up, then distribute from the roots down."""
    belief = model.node[f.cell].copy()
    up = np.zeros((len(f.cell), 2))  # message of a node to its parent, by the parent's label
    edges = model.edge[f.kind]  # nodes x parent label x child label
    for rows in reversed(f.levels):
        z = edges[rows] + belief[rows][:, None, :]
        message = np.logaddexp(z[:, :, 0], z[:, :, 1])
        message -= message.max(1, keepdims=True)
        up[rows] = message
        np.add.at(belief, f.parent[rows], message)
    roots = f.starts[:-1]
    belief[roots] += model.root
    for rows in f.levels:
        top = belief[f.parent[rows]] - up[rows]  # the parent without what this child told it
        z = edges[rows] + top[:, :, None]
        message = np.logaddexp(z[:, 0, :], z[:, 1, :])
        message -= message.max(1, keepdims=True)
        belief[rows] += message
    return 1.0 / (1.0 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))


def node_labels(f: Forest) -> np.ndarray:
    """0/1 for every node of labelled pages, -1 elsewhere; an inner node has the label of most of its text."""
    score = np.where(f.leaf, f.chars * f.label, 0).astype(np.int64)
    for rows in reversed(f.levels):
        np.add.at(score, f.parent[rows], score[rows])
    known = np.repeat(np.add.reduceat(np.abs(f.label), f.starts[:-1]) > 0, np.diff(f.starts))
    own = np.where(f.leaf | (score == 0), f.label > 0, score > 0)
    return np.where(known, own.astype(np.int8), -1)


def count(f: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training counts of the labelled pages of a forest."""
    y = node_labels(f)
    node = np.zeros((int(np.prod(SHAPE)), 2))
    edge = np.zeros((N_KINDS, 2, 2))
    known = y >= 0
    np.add.at(node, (f.cell[known], y[known]), 1)
    inner = known & (f.parent != np.arange(len(f.parent)))
    np.add.at(edge, (f.kind[inner], y[f.parent[inner]], y[inner]), 1)
    roots = f.starts[:-1]
    roots = roots[y[roots] >= 0]
    return node, edge, np.bincount(y[roots], minlength=2)[:2].astype(float)


def train(pages: DataFrame, limit: int = TRAIN_PAGES) -> Model:
    """Model fitted on at most ``limit`` labelled pages: those with the smallest hashes among pages with content marks."""
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    keyed = marked.select(F.xxhash64("html").alias("h"), "html")
    last = keyed.select("h").distinct().orderBy("h").limit(limit).agg(F.max("h").alias("h")).first()["h"]
    # the pages are read again below the bound: only hashes were sorted, no page but the sample's is shuffled
    sample = keyed.where(F.lit(False) if last is None else F.col("h") <= F.lit(last)).dropDuplicates(["h"])

    def run(batches):
        for batch in batches:
            node, edge, root = count(Forest([parse(x) for x in batch.column(0).to_pylist()])) if batch.num_rows else (np.zeros((int(np.prod(SHAPE)), 2)), np.zeros((N_KINDS, 2, 2)), np.zeros(2))
            flat = np.concatenate([node.ravel(), edge.ravel(), root])
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at])], ["at", "n"])

    counted = sample.select("html").mapInArrow(run, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    cells = int(np.prod(SHAPE)) * 2
    flat = np.zeros(cells + N_KINDS * 4 + 2)
    for r in counted:  # at most as many rows as the model has numbers
        flat[r["at"]] = r["n"]
    return Model.from_counts(flat[:cells].reshape(-1, 2), flat[cells:-2].reshape(N_KINDS, 2, 2), flat[-2:])


def extract(pages: list[str | None], model: Model) -> list[dict]:
    """Extracted text of each page, number of text nodes, of kept ones, and the mean certainty of the decisions."""
    trees = [parse(p) for p in pages]
    f = Forest(trees)
    p = marginals(f, model)
    out = []
    for t, a in zip(trees, f.starts.tolist()):
        parts, kept, total, sure, last = [], 0, 0, 0.0, None
        block = [0] * len(t.tag)
        for k in range(1, len(t.tag)):
            block[k] = k if t.tag[k] in BLOCK or t.tag[k] == "br" else block[t.parent[k]]
            if t.tag[k] == "br":
                last = None
            if t.text[k] is None:
                continue
            total += 1
            q = p[a + k]
            sure += max(q, 1.0 - q)
            if q >= 0.5:
                kept += 1
                piece = " ".join(t.text[k].split())
                if last == block[k] and parts:
                    parts[-1] += (" " if t.text[k][:1].isspace() or parts[-1].endswith(" ") else "") + piece
                else:
                    parts.append(piece)
                if t.text[k][-1:].isspace():
                    parts[-1] += " "
                last = block[k]
        out.append({"text": "\n".join(x.strip() for x in parts), "n_nodes": total, "n_kept": kept, "certainty": round(float(sure) / total, 4) if total else None})
    return out


def extract_pages(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_nodes, n_kept, certainty of every page.

    Null and empty pages and pages without text give an empty text and no certainty. Where no page is labelled, the
    potentials are even and every text node is kept. Repeated rows give equal results; a page is read whole;
    columns beyond page_id, url and html play no part. An empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    fitted = model or train(pages)

    @F.arrow_udf(RESULT)
    def text(column: pa.Array) -> pa.Array:
        rows, held, size = [], [], 0
        for page in column.to_pylist():
            held.append(page)
            size += len(page or "")
            if size >= BATCH_CHARS:
                rows += extract(held, fitted)
                held, size = [], 0
        rows += extract(held, fitted) if held else []
        return pa.array(rows, pa.struct([("text", pa.string()), ("n_nodes", pa.int32()), ("n_kept", pa.int32()), ("certainty", pa.float64())]))

    return spread(pages.select("page_id", "url", "html")).select("page_id", "url", text("html").alias("x")).select("page_id", "url", "x.*")
