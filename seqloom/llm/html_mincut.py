"""Main-text extraction by minimum-cut labelling.

A page becomes a row of text blocks. A logistic classifier turns each block's features into the cost of
calling it content or boilerplate (terminal capacities); neighbours in the page, and blocks that are close in the
document tree, are tied by smoothness edges. The minimum cut, found by max-flow, separates content
from boilerplate.

The classifier is trained here, on a bounded sample of pages (``pages``), from what the markup itself says:
blocks in article or main elements against blocks in navigation, header, footer, aside and form elements. Blocks
are also shown to it with those elements hidden, so that it learns from text and links as well.

Readers' comments needn't be named so: what repeats after prose under bylines, or stands below a heading that says comments, is
a feature of its own (``replies``).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import stage

# Comments, elements without prose, declarations and bogus comments, tags. A quoted value counts as one only if a blank, / or > follows it, so an
# unpaired quote doesn't hide what comes after it. All loops are possessive. {} is what ends a tag.
_TOKEN = r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(script|style|noscript|template|svg|textarea|iframe)(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)|<(?:[!?]|/[^a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+){}"
CAREFUL = re.compile(_TOKEN.format(r"((?:[^>=]++|=\s*+\"[^\"]*+\"(?=[\s/>])|=\s*+'[^']*+'(?=[\s/>])|=)*+)>") + "|(<)(?=/?[a-zA-Z])", re.S | re.I)
PLAIN = re.compile(_TOKEN.format(r"([^>]*+)(?:>|\Z)"), re.S | re.I)
NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Element names of HTML and usual names of page parts.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GOOD = ("article", "main")
BAD = ("nav", "header", "footer", "aside", "form", "head", "menu", "button", "select")
BAD_NAME = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|side-?bar|menu|nav\w*|navigation|breadcrumb\w*|footer|header|masthead|cookie\w*|consent|notice|popup|modal|newsletter|subscribe|signup|login|search|share|social|related|recommend\w*|widget|comments?|respond|replies|reply|disqus|complementary|contentinfo|pagination|pager|toolbar|legal|copyright|alert|outbrain|taboola)(?:$|[\s_-])", re.I)
GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text)(?:$|[\s_-])", re.I)


# What holds for an element or one it lies in.
IN_GOOD, IN_BAD, BAD_NAMED, GOOD_NAMED, IN_PROSE, IN_HEADING = (1 << i for i in range(6))
# Dates, times of day and spans of time as bylines give them; headings over comments.
DATED = re.compile(r"\b\d{4}[-/.]\d{1,2}[-/.]\d{1,2}\b|\b\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}\b|\b\d{1,2}:\d\d\b|\b\d{1,2}\.? (?:de )?[^\W\d]{3,10}\.?,?(?: de)? \d{4}\b|\b[^\W\d]{3,10}\.? \d{1,2},? \d{4}\b|\b(?:\d+|an?) [^\W\d]{1,8} ago\b|\b(?:hace|vor|il y a) (?:\d+|un[ea]?|eine[mr]?)\b", re.I)
ABOVE_REPLIES = re.compile(r"\W*\d*\W*(?:(?:user|reader|visitor)s?\W{0,2}s? )?(?:comments?|responses?|replies|reactions?|opinions|kommentare?|commentaires?|r\u00e9actions?|comentarios?|opiniones)(?: from (?:our )?readers)?\W*\d*\W*", re.I)
LEVELS = 5  # ancestors of a block that may be the element of one comment
BYLINE = 8  # words
LONGEST_HEADING = 100  # characters of a heading over comments
NO_REPLY = frozenset("html body main table tbody thead tr td th dl dt dd ul ol p".split())
FAR = 32  # steps between blocks in the document tree beyond which an edge has no weight


@dataclass(frozen=True, eq=False)
class Node:
    """An element: its parent, depth and what it has from its ancestors, so that no block needs its whole path."""

    tag: str
    parent: Node | None
    depth: int
    marks: int
    names: str = ""


ROOT = Node("", None, 0, 0)


@dataclass
class Block:
    """A run of text between block boundaries, in its innermost open element."""

    text: str
    node: Node
    link: int
    time: str = ""  # what of it lies in time elements
    reply: bool = False


def _child(parent: Node, tag: str, attributes: str) -> Node:
    names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes)) if "=" in attributes else ""
    marks = parent.marks
    if names:
        marks |= BAD_NAMED if BAD_NAME.search(names) else GOOD_NAMED if GOOD_NAME.search(names) else 0
    marks |= (IN_GOOD if tag in GOOD else 0) | (IN_BAD if tag in BAD else 0) | (IN_PROSE if tag in ("p", "pre", "blockquote") else 0)
    marks |= IN_HEADING if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() else 0
    return Node(tag, parent, parent.depth + 1, marks, names)


# Which open element the start of another one closes.
CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}
CLOSES |= {t: ("p",) for t in "p h1 h2 h3 h4 h5 h6 div ul ol table section article".split()}


def parse(page: str) -> list[Block]:
    """Text blocks in page order; comments, scripts and styles are gone, references decoded, white space folded.

    One pass: an element is opened and closed once, a closing tag without an open element is passed over by a count,
    and where quotes leave a tag without its end, this and all later tags of the page end at the next >.
    """
    out: list[Block] = []
    stack = [ROOT]
    blocks: list[int] = []  # places of block elements on the stack
    opened: Counter[str] = Counter()
    held: list[str] = []
    linked = 0
    anchors = 0
    timed: list[str] = []

    def flush() -> None:
        nonlocal held, linked, timed
        text = " ".join("".join(held).split())
        if text:
            out.append(Block(text, stack[-1], min(linked, len(text)), " ".join("".join(timed).split())))
        held, linked, timed = [], 0, []

    def close(place: int) -> None:
        for node in stack[place:]:
            opened[node.tag] -= 1
        del stack[place:]
        while blocks and blocks[-1] >= place:
            blocks.pop()

    at, token = 0, CAREFUL
    while m := token.search(page, at):
        if token is CAREFUL and m[5]:
            token = PLAIN
            m = token.match(page, m.start())
        raw = page[at : m.start()]
        at = m.end()
        if raw:
            held.append(html.unescape(raw))
            linked += len(raw) if anchors else 0
            if opened["time"]:
                timed.append(html.unescape(raw))
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if m[2]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            if tag in BLOCKS:
                flush()
            if opened[tag]:
                place = len(stack) - 1
                while stack[place].tag != tag:
                    place -= 1
                close(place)
            continue
        if tag == "br":
            held.append(" ")
        if tag in BLOCKS:
            flush()
            if tag in CLOSES and blocks and stack[blocks[-1]].tag in CLOSES[tag]:
                close(blocks[-1])
        if tag not in VOID and not m[4].rstrip().endswith("/"):
            anchors += tag == "a"
            opened[tag] += 1
            if tag in BLOCKS:
                blocks.append(len(stack))
            stack.append(_child(stack[-1], tag, m[4]))
    held.append(html.unescape(page[at:]))
    flush()
    for i in replies(out):
        out[i].reply = True
    return out


def apart(a: Node, b: Node) -> int:
    """Steps between two elements in the document tree; over FAR if they are further apart."""
    steps = 0
    while a is not b and steps <= FAR:
        steps += 1
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return steps


def _signed(blocks: list[Block]) -> bool:
    """Whether a short block at the start or end holds a date, and something else is said in it or in a short block before it."""
    before = False
    for b in [*blocks[:2], *blocks[2:][-1:]]:
        if b.text.count(" ") >= BYLINE:
            before = False
            continue
        rest = DATED.sub("", b.text.replace(b.time, "", 1) if b.time else b.text)
        named = any(c.isalpha() for c in rest)
        if (b.time or rest != b.text) and (named or before):
            return True
        before = named
    return False


def replies(blocks: list[Block]) -> set[int]:
    """Places of blocks that look like readers' comments: in signed elements without a heading that repeat side by side, or below a heading that says so.

    Only what follows prose can be one. A block looks at ``LEVELS`` of its ancestors and is in at most as many elements, so the work is linear in a page.
    """
    inside: dict[Node, list[int]] = {}
    prose = len(blocks)  # the first block of prose
    for i, b in enumerate(blocks):
        if prose == len(blocks) and (b.node.marks & IN_PROSE or b.text.count(" ") >= BYLINE) and b.link * 2 < len(b.text) and not b.node.marks & (IN_BAD | BAD_NAMED | IN_HEADING):
            prose = i
        node: Node | None = b.node
        for _ in range(LEVELS):
            if node is None or node is ROOT:
                break
            if node.tag not in NO_REPLY:
                inside.setdefault(node, []).append(i)
            node = node.parent
    alike: dict[tuple[Node | None, str, str], list[Node]] = {}
    for node, own in inside.items():
        if len(own) > 1 and not any(blocks[i].node.tag in ("h1", "h2", "h3") for i in own) and _signed([blocks[i] for i in own]):
            alike.setdefault((node.parent, node.tag, node.names), []).append(node)
    found = {i for nodes in alike.values() if len(nodes) > 1 and inside[nodes[0]][0] > prose for node in nodes for i in inside[node]}
    below: Node | None = None  # the heading's parent
    level = ""
    for i, b in enumerate(blocks):
        heading = b.node.marks & IN_HEADING
        if below is not None and (b.node.tag == level or not _within(b.node, below)):
            below = None
        if below is None and heading and i > prose and b.node.tag != "h1" and len(b.text) < LONGEST_HEADING and ABOVE_REPLIES.fullmatch(b.text):
            below, level = b.node.parent, b.node.tag
        if below is not None:
            found.add(i)
    return found


def _within(node: Node | None, other: Node) -> bool:
    for _ in range(FAR):
        if node is None or node.depth < other.depth:
            return False
        if node is other:
            return True
        node = node.parent
    return False


FEATURES = 15
HEADING_TIE = 2.0


def features(b: Block, hide: bool = False) -> list[float]:
    marks, inner = b.node.marks, b.node.tag
    words = b.text.count(" ") + 1
    stops = sum(b.text.count(c) for c in ".,;:!?")
    shown = 0 if hide else marks
    return [
        1.0,
        float(bool(shown & IN_GOOD)),
        float(bool(shown & IN_BAD)),
        float(bool(shown & BAD_NAMED)),
        float(bool(shown & GOOD_NAMED)),
        b.link / len(b.text),
        math.log1p(words) / 4,
        min(1.0, stops / words),
        float(b.text[-1] in ".!?:\"'"),
        float(bool(marks & IN_PROSE)),
        float(inner in ("li", "dt", "dd", "td", "th")),
        float(bool(marks & IN_HEADING)),
        float("\N{COPYRIGHT SIGN}" in b.text),
        float(words <= 3),
        float(b.reply),
    ]


def weak_label(b: Block) -> int | None:
    """What the markup says of a block: 1 content, 0 boilerplate, None nothing."""
    if b.reply or b.node.marks & (IN_BAD | BAD_NAMED):
        return 0
    return 1 if b.node.marks & IN_GOOD else None


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = [], []
        for page in batch.column(0).to_pylist():
            for b in parse(page or ""):
                label = weak_label(b)
                if label is not None:
                    for hide in (False, True):
                        x.append(features(b, hide))
                        y.append(float(label))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.float64())], ["x", "y"])


#: Known before any page is seen; what training starts from and shrinks to.
PRIOR = np.array([-1.0, 4.0, -7.0, -7.0, 1.0, -2.0, 1.0, 0.5, 0.5, 0.5, -0.5, 0.0, -1.0, -0.5, -16.0])


def train(pages: DataFrame, most: int = 400, rounds: int = 200, shrink: float = 0.02) -> np.ndarray:
    """Weights of the block classifier; the prior without examples. Fitted on ``most`` different pages, those of least hash, read whole."""
    hashed = pages.select("html", F.xxhash64("html").alias("h")).where("html is not null")
    chosen = stage(hashed.select("h").distinct().orderBy("h").limit(most), "html-chosen")
    sample = hashed.join(F.broadcast(chosen), "h").groupBy("h").agg(F.max("html").alias("html")).select("html")
    got = sample.repartition(12).mapInArrow(_examples, "x array<double>, y double").groupBy("x", "y").agg(F.count("*").alias("n")).toPandas()
    w = PRIOR.copy()
    if not len(got):
        return w
    x, y = np.array(got["x"].tolist()), got["y"].to_numpy()
    n = got["n"].to_numpy(float)
    n = n / n.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 1.0 * (x.T @ (n * (p - y)) + shrink * (w - PRIOR))
    return w


def min_cut(gain: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels that minimise the summed costs: cutting off a node of positive gain costs it, keeping one of negative
    gain costs its absolute value, and separating an edge's ends costs the edge. Max-flow by shortest augmenting paths."""
    n = len(gain)
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, ab: float, ba: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(ab)
        out[b].append(len(to))
        to.append(a)
        room.append(ba)

    for i, g in enumerate(gain):
        if g > 0:
            link(s, i, float(g), 0.0)
        else:
            link(i, t, float(-g), 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            v = queue.popleft()
            for e in out[v]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return np.array([level[i] >= 0 for i in range(n)])
        turn = [0] * (n + 2)
        path: list[int] = []
        v = s
        while True:
            if v == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                v = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[v] < len(out[v]):
                e = out[v][turn[v]]
                if room[e] > 1e-9 and level[to[e]] == level[v] + 1:
                    break
                turn[v] += 1
            if turn[v] < len(out[v]):
                path.append(out[v][turn[v]])
                v = to[path[-1]]
            elif path:
                e = path.pop()
                v = to[e ^ 1]
                turn[v] += 1
            else:
                break


def extract(page: str, weights: np.ndarray, tie: float = 0.6) -> str:
    """The content blocks of a page, joined by line feeds."""
    blocks = parse(page)
    if not blocks:
        return ""
    gain = np.clip(np.array([features(b) for b in blocks]) @ weights, -30, 30)
    edges = []
    last: dict[Node, int] = {}
    for i, b in enumerate(blocks):
        if i:
            steps = apart(blocks[i - 1].node, b.node)
            if steps <= FAR:
                over = blocks[i - 1].node.marks & IN_HEADING and not b.node.marks & IN_HEADING and steps <= 2  # a heading goes with what it stands over
                edges.append((i - 1, i, HEADING_TIE if over else tie * 0.5**steps))
        parent = b.node.parent
        if parent is not None and parent is not ROOT:
            if parent in last and last[parent] < i - 1:
                edges.append((last[parent], i, tie / 2))
            last[parent] = i
    keep = min_cut(gain, edges)
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def _extractor(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value
        for batch in batches:
            texts = [extract(p or "", weights) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages(page_id, url, html)``.

    Null and empty html and pages without content give ''. Repeated rows are extracted each; keys are passed
    through, null or not. Further columns are ignored; empty input gives an empty result.
    """
    model = pages.sparkSession.sparkContext.broadcast(train(pages))
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(_extractor(model), "page_id long, url string, text string, n_chars long")
