"""Main text of web pages by a tree-structured graphical model.

Block elements and text blocks of a page are the nodes of a tree, each main text or not. A node's own evidence is its
tag, the words of its class, id and role, and for a block its length, links and ending; potentials between parent and
child tie them together. Sum-product messages go up the tree and down again and give each block its marginal. Evidence
and potentials are learned by counting on labelled pages.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import Batches, PlainNames, map_batches, text_slices
from riskflow.llm.labelled_pages import labelled_pages

BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5
    h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul""".split()
)
# Elements whose content is no markup and no text of the page. Without an end tag they go on to the end of the page.
SKIPPED = frozenset("script style textarea title iframe".split())
# Their text, shown in their place or where they cannot be shown, belongs to the block around them.
REPLACED = frozenset("noscript svg object canvas audio video".split())
# Nodes of the tree that do not end the text around them. What is in them is evidence for a button.
CONTROLS = frozenset("button select".split())
KIND = {"select": "button", "option": "button"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag ends an open element of the same group.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "button": {"button"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "button": BLOCKS | {"select"}}

_OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_IN_TAG = re.compile(r"[^>=]*+(?:(>)|=\s*+([\"']?))")
_NAMED = re.compile(r"(?:^|\s)(class|id|role|data-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TEMPLATE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|iframe)\b.*?(?:</\1\b[^>]*(?:>|\Z)|\Z)|<(/?)template(?:[\s/][^>]*)?(?:>|\Z)", re.S | re.I)
_LEADING_ZEROS, _BEYOND_UNICODE = re.compile(r"&#0+(?=[0-9])"), re.compile(r"&#[0-9]{8,};?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")

THRESHOLD = 0.5
LEAST_COUNT = 3


@dataclass
class Node:
    parent: int
    features: list[str]
    label: str = ""
    text: str | None = None  # of a text block
    linked: int = 0  # characters of it inside links


@dataclass
class Model:
    weights: dict[str, tuple[float, float]]  # of a feature, the log probabilities in both states
    edges: list[list[float]]  # [state of the parent][state of the child]
    root: list[float] = field(default_factory=lambda: [0.5, 0.5])


def _length(words: int) -> str:
    return f"words={min(words.bit_length(), 6)}"


def _text(raw: str) -> str:
    """Character references decoded; a number beyond Unicode, however long, is the replacement character."""
    if "&#" in raw:
        raw = _BEYOND_UNICODE.sub("\ufffd", _LEADING_ZEROS.sub("&#", raw))
    return _SPACE.sub(" ", html.unescape(raw)).strip()


class Tags:
    """The tags of a page, read once and forward.

    A quote opens a value after `=` only. One that never closes is a character like others; so is a `<` whose tag does not
    end. Once a tag ran to the end of the page because each `>` was in a quoted value, quotes count no more.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}
        self.quotes = True

    def _end(self, at: int) -> int:
        """Where the `>` of a tag is, read from `at`; -1 without one."""
        if at > self.last[">"]:
            return -1
        if not self.quotes:
            return self.page.find(">", at)
        begin = at
        while token := _IN_TAG.match(self.page, at):
            at = token.end()
            if token.group(1):
                return at - 1
            quote = token.group(2)
            if quote and at <= self.last[quote]:
                at = self.page.find(quote, at) + 1
        self.quotes = False
        return self.page.find(">", begin)

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """The next tag or comment: where it begins and ends, whether it is an end tag, its name ("" for others), attributes."""
        while opening := _OPENING.search(self.page, at):
            comment, other, closing, name = opening.groups()
            if comment:
                end = self.page.find("-->", opening.end())
                return opening.start(), len(self.page) if end < 0 else end + 3, False, "", ""
            end = self.page.find(">", opening.end()) if other else self._end(opening.end())
            if end >= 0:
                return opening.start(), end + 1, bool(closing), "" if other else name.lower(), self.page[opening.end() : end]
            if other or opening.end() > self.last[">"]:
                # No tag ends any more: only a comment can follow.
                at = self.page.find("<!--", opening.end())
                if at < 0:
                    return None
            else:
                at = opening.end()
        return None


def _template_ends(page: str) -> dict[int, int]:
    """Where the content of each template begins, and where its end tag ends. One without an end tag is not among them."""
    ends, begun = {}, []
    if "<template" in page.lower():
        for tag in _TEMPLATE.finditer(page):
            if tag.group(2) == "":
                begun.append(tag.end())
            elif tag.group(2) and begun:
                ends[begun.pop()] = tag.end()
    return ends


def parse(page: str) -> list[Node]:
    """The nodes of a page in document order; parents come before their children."""
    nodes = [Node(-1, ["tag=#root"])]
    # Open elements: name, node, and for a control the text before it that goes on after it.
    stack: list[tuple[str, int, tuple[list[str], int] | None]] = [("#root", 0, None)]
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack the elements of a name are
    waiting: list[int] = []  # where in it the controls are whose text before has not become a block
    pieces: list[str] = []
    linked = in_link = 0
    at, end = 0, len(page)

    templates = _template_ends(page)
    tags = Tags(page)

    def flush(top: int = -1) -> None:
        nonlocal linked
        if pieces:
            text = _text("".join(pieces))
            pieces.clear()
            if text:
                share = linked / max(len(text), 1)
                last = text[-1]
                features = [
                    "block",
                    _length(text.count(" ") + 1),
                    "links=" + ("no" if not linked else "all" if share > 0.8 else "some" if share > 0.25 else "few"),
                    "end=" + (last if last in ".!?:,\"" else "letter" if last.isalnum() else "mark"),
                    "in=" + KIND.get(stack[top][0], stack[top][0]),
                ]
                nodes.append(Node(stack[top][1], features, text=text, linked=linked))
        linked = 0

    def begin(name: str, before: tuple[list[str], int] | None = None) -> None:
        places[name].append(len(stack))
        if before:
            waiting.append(len(stack))
        stack.append((name, len(nodes) - 1, before))

    def finish() -> tuple[list[str], int] | None:
        name, _, before = stack.pop()
        places[name].pop()
        if waiting and waiting[-1] == len(stack):
            waiting.pop()
        return before

    def close(index: int) -> None:
        nonlocal pieces, linked
        while len(stack) > index:
            flush()
            if before := finish():
                pieces, linked = before

    def highest(names: frozenset[str] | set[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def flush_before() -> None:
        """The text before open controls comes before that of blocks in them."""
        nonlocal pieces, linked
        inner = pieces, linked
        for i in waiting:
            name, node, before = stack[i]
            pieces, linked = before
            stack[i] = name, node, ([], 0)
            flush(i - 1)
        waiting.clear()
        pieces, linked = inner

    while at < end:
        tag = tags.next(at)
        piece = page[at : tag[0]] if tag else page[at:]
        if piece:
            pieces.append(piece)
            if in_link:
                linked += len(piece)
        if tag is None:
            break
        _, at, closing, name, rest = tag
        if not name:
            continue
        if name in SKIPPED:
            if not closing and not rest.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else end
                pieces.append(" ")
        elif name == "a":
            in_link = 0 if closing else 1
        elif name == "br" or name in REPLACED:
            pieces.append(" ")
        elif name == "template":
            at = templates.get(at, at)
            pieces.append(" ")
        elif name in BLOCKS or name in CONTROLS:
            if closing:
                if places[name]:
                    close(places[name][-1])
                elif name in BLOCKS:
                    flush()
                continue
            if name in BLOCKS:
                if name != "option":
                    flush_before()
                flush()
            if name in CLOSES:
                scope = highest(SCOPES[name])
                while (index := highest(CLOSES[name])) > scope:
                    close(index)
            if stack[-1][0] == "p" and name in BLOCKS:
                finish()
            words, label = [], ""
            if rest:
                for key, *values in _NAMED.findall(rest):
                    value = "".join(values)
                    if key.lower() == "data-label":
                        label = value
                    else:
                        words += [w.lower() for w in _WORD.findall(value)]
            nodes.append(Node(stack[-1][1], [f"tag={KIND.get(name, name)}", *(f"name={w}" for w in sorted(set(words)))], label))
            if name in CONTROLS:
                if not rest.endswith("/"):
                    pieces.append(" ")
                    begin(name, (pieces, linked))
                    pieces, linked = [], 0
            elif name not in VOID:
                begin(name)
    flush_before()
    close(1)
    flush()
    _add_link_shares(nodes)
    return nodes


def _add_link_shares(nodes: list[Node]) -> None:
    """An element's tag is seen together with how much of its text is linked: a menu's list is not an article's."""
    size, linked = [0] * len(nodes), [0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        if node.text is not None:
            size[i], linked[i] = len(node.text), node.linked
        size[node.parent] += size[i]
        linked[node.parent] += linked[i]
    for node, n, k in zip(nodes, size, linked, strict=True):
        if node.text is None:
            share = "empty" if not n else "none" if not k else "all" if k > 0.8 * n else "some" if k > 0.25 * n else "few"
            node.features[0] += f":{share}"


def _states(nodes: list[Node]) -> list[int]:
    """For a labelled page: is a node main text? Of an element, if half of its text or more is."""
    labels = [""] * len(nodes)
    size, main = [0] * len(nodes), [0] * len(nodes)
    for i, node in enumerate(nodes):
        labels[i] = node.label or (labels[node.parent] if node.parent >= 0 else "")
        if node.text is not None:
            size[i] = len(node.text)
            main[i] = size[i] * (labels[i] == "main")
    for i in range(len(nodes) - 1, 0, -1):
        size[nodes[i].parent] += size[i]
        main[nodes[i].parent] += main[i]
    return [int(2 * m >= s and s > 0) for m, s in zip(main, size, strict=True)]


def train(pages: list[str]) -> Model:
    counts: dict[str, Counter] = defaultdict(Counter)
    kinds: dict[str, Counter] = defaultdict(Counter)
    edges = [[1.0, 1.0], [1.0, 1.0]]
    root = [1.0, 1.0]
    for page in pages:
        nodes = parse(page)
        states = _states(nodes)
        root[states[0]] += 1
        for node, state in zip(nodes, states, strict=True):
            if node.parent >= 0:
                edges[states[node.parent]][state] += 1
            kind = "block" if node.text is not None else "element"
            kinds[kind][state] += 1
            for f in node.features:
                counts[f][state] += 1
    weights = {}
    for feature, by_state in counts.items():
        if sum(by_state.values()) >= LEAST_COUNT:
            kind = kinds["block" if feature.startswith(("block", "words=", "links=", "end=", "in=")) else "element"]
            weights[feature] = tuple(math.log((by_state[s] + 0.5) / (kind[s] + 1)) for s in (0, 1))
    return Model(weights, [[x / sum(row) for x in row] for row in edges], [x / sum(root) for x in root])


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """The probability of main text of each node, by messages up and down the tree."""
    n = len(nodes)
    weights, edges = model.weights, model.edges
    own0, own1 = [1.0] * n, [1.0] * n  # evidence of a node and of all below it
    up0, up1 = [1.0] * n, [1.0] * n  # its message to the parent
    for i, node in enumerate(nodes):
        a = b = 0.0
        for f in node.features:
            w = weights.get(f)
            if w:
                a += w[0]
                b += w[1]
        d = max(-30.0, min(30.0, b - a))
        own1[i] = 1 / (1 + math.exp(-d))
        own0[i] = 1 - own1[i] if d < 20 else math.exp(-d)
    for i in range(n - 1, 0, -1):
        x, y = own0[i], own1[i]
        m0, m1 = edges[0][0] * x + edges[0][1] * y, edges[1][0] * x + edges[1][1] * y
        s = m0 + m1
        up0[i], up1[i] = m0 / s, m1 / s
        p = nodes[i].parent
        x, y = own0[p] * up0[i], own1[p] * up1[i]
        s = x + y
        own0[p], own1[p] = x / s, y / s
    down0, down1 = [0.0] * n, [0.0] * n
    down0[0], down1[0] = model.root
    out = [0.0] * n
    for i in range(n):
        if i:
            p = nodes[i].parent
            # What the parent believes without this child's message.
            x, y = down0[p] * own0[p] / max(up0[i], 1e-300), down1[p] * own1[p] / max(up1[i], 1e-300)
            s = x + y
            x, y = x / s, y / s
            down0[i], down1[i] = edges[0][0] * x + edges[1][0] * y, edges[0][1] * x + edges[1][1] * y
        x, y = down0[i] * own0[i], down1[i] * own1[i]
        out[i] = y / (x + y) if x + y else 0.0
    return out


def main_text(page: str, model: Model) -> str:
    nodes = parse(page)
    beliefs = marginals(nodes, model)
    return "\n\n".join(n.text for n, p in zip(nodes, beliefs, strict=True) if n.text is not None and p >= THRESHOLD)


def extract(pages: DataFrame, model: Model | None = None, html_column: str = "html") -> DataFrame:
    """`pages` with text and n_chars in place of the html column.

    Null and empty pages, and pages without main text, have an empty text. Columns named text and n_chars are replaced.
    """
    model = model or train(labelled_pages())
    plain = PlainNames(pages.drop(*(c for c in ("text", "n_chars") if c != html_column)))
    html_name = plain.own.pop(html_column)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in text_slices(batch, html_name):
                texts = [main_text(p or "", model) for p in part.column(html_name).to_pylist()]
                columns = [part.column(i) for i, c in enumerate(part.schema.names) if c != html_name]
                columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*(c for c in part.schema.names if c != html_name), "text", "n_chars"])

    schema = plain.df.drop(html_name).withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema
    return plain.restored(map_batches(plain.df, run, schema), "text", "n_chars")
