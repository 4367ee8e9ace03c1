"""HTML extraction (operator 3) by minimum-cut labelling.

A page is cut into blocks of text at block-level tags. A classifier gives every block the probability to be content;
the costs -log(p) and -log(1-p) become the capacities of its edges to the two terminals. Blocks that follow each other,
and blocks that follow each other under the same parent, are joined by smoothness edges that weaken with their distance in the
DOM. The minimum cut, found by maximum flow, labels all blocks of the page at once. Blocks whose terminal
capacities outweigh all their smoothness edges are settled first, which leaves the cut the same and the flow small.

The classifier adds what markup says (elements, class, id and role words: fixed weights) and what the text looks like: a logistic model of
length, links, marks and position, trained on a bounded sample of blocks that the markup labels by itself. The name of a wrapper
says nothing of what it wraps: html and body count nothing, and elements around the page's main part (``wrappers``) lose their penalty.

Pages are read one by one: nothing is shuffled, no key can be hot. Defined cases: a null or empty page has the
empty text; null ids and urls and repeated rows are rows like others; equal costs make a block boilerplate; without any
block to learn from the text counts nothing; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, col, slices

#: Pages, and blocks of them, that the text model may learn from.
SAMPLE_PAGES, SAMPLE_BLOCKS = 2_000, 50_000

#: Element names.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noscript iframe noembed noframes template svg math".split())
SILENT = RAW | frozenset("head select option button object canvas audio video datalist".split())
#: An element that closes an open one of its kind up to the nearest of the elements named last.
IMPLIED = {"p": ("p", ""), "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
           "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
#: Words of class, id and role, and elements, that speak against content or for it.
AGAINST = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent
gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar rail widget widgets related recommended
recommendations trending share sharing social nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar toolbar
comment comments reply replies respond disqus form search pagination pager copyright legal disclaimer contentinfo complementary
dialog skip skiplink aside""".split())
HEADERS = frozenset("header banner".split())
FOR = frozenset("article main content post entry story text".split())
AGAINST_TAGS = frozenset("nav footer aside form menu dialog".split())
FOR_TAGS_ORDERED = ("main", "article")
FOR_TAGS = frozenset(FOR_TAGS_ORDERED)
#: Weights of the markup, in log-odds.
W_AGAINST, W_FOR, W_HINT, W_PROSE, W_TEXT, W_SMOOTH = -9.0, 4.0, 1.5, 0.5, 1.5, 1.0
#: The share of the page's text that makes an article its main part, and, on pages without one, an element a wrapper.
MAIN_SHARE, WRAPPED_SHARE = 1 / 3, 0.8

TAG = re.compile(r"""<!--(?:.*?-->|.*\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![\w"'-])(hidden)(?![\w=-])""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MARKS = re.compile(r"[.!?;:,…。！？]")


def markup_weight(tag: str, attributes: str, inside: bool, wrapper: bool = False) -> float:
    """What an element says of the text in it, in log-odds; ``inside``: it stands in an article or main part; ``wrapper``: only
    whether it is hidden, and what speaks for it, count."""
    if tag in ("html", "body"):
        return 0.0
    weight = 0.0
    if (tag in AGAINST_TAGS or tag == "header" and not inside) and not wrapper:
        weight += W_AGAINST
    elif tag in FOR_TAGS:
        weight += W_FOR
    if attributes and "=" in attributes or "hidden" in attributes:
        words: set[str] = set()
        for name, a, b, c, flag in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if flag or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                weight += W_AGAINST
            elif name in ("class", "id", "role"):
                words.update(w.lower() for w in NAME_WORD.findall(value))
        good = words & FOR
        if (words & AGAINST - HEADERS or words & HEADERS and not inside and not good) and not wrapper:
            weight += W_AGAINST
        elif good:
            weight += W_HINT
    return weight


class Block:
    __slots__ = ("text", "links", "weight", "path", "prose")

    def __init__(self, text: str, links: int, weight: float, path: tuple[int, ...], prose: bool) -> None:
        self.text, self.links, self.weight, self.path, self.prose = text, links, weight, path, prose


def wrappers(blocks: list[Block], parts: dict[int, str], penal: dict[int, tuple[str, str, bool]]) -> set[int]:
    """The penalised elements that wrap the page's main part: those around the main element with most text (and it itself), those
    around the article with most text if that is a good part of the page's, and where there is neither those around nearly
    all text. Elements that are against by their tag wrap only if they are forms."""
    size: dict[int, int] = {}
    above: dict[int, tuple[int, ...]] = {}
    for b in blocks:
        for at, number in enumerate(b.path):
            size[number] = size.get(number, 0) + len(b.text)
            if number in parts and number not in above:
                above[number] = b.path[:at]
    out: set[int] = set()
    mains, articles = ([n for n in above if parts[n] == tag] for tag in FOR_TAGS_ORDERED)
    if mains:
        most = max(mains, key=lambda n: size[n])
        out.update(above[most], [most])
    if articles:
        most = max(articles, key=lambda n: size[n])
        if size[most] >= MAIN_SHARE * size[0]:
            out.update(above[most])
            if 2 * size[most] >= size[0]:
                out.add(most)
    if not out:
        out.update(n for n in penal if size.get(n, 0) >= WRAPPED_SHARE * size[0])
    return {n for n in out if n in penal and penal[n][0] not in AGAINST_TAGS - {"form"}}


def closed(page: str, at: int, name: str, around: set[str]) -> bool:
    """Whether the silent element opened before ``at`` has its end tag: before another one of its kind opens and before an element that
    it stands in closes."""
    inner: dict[str, int] = {}
    for m in TAG.finditer(page, at):
        end, tag = (m[2], m[3]) if m[3] else (m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if tag == name:
            return bool(end)
        if tag in BLOCK:
            if not end:
                inner[tag] = inner.get(tag, 0) + 1
            elif inner.get(tag):
                inner[tag] -= 1
            elif tag in around:
                return False
    return False


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of visible text in page order; tolerant of missing and misplaced tags."""
    out: list[Block] = []
    # open block-level elements: name, weight summed from the root, number, whether in an article or main part
    stack: list[tuple[str, float, int, bool]] = [("", 0.0, 0, False)]
    number, parts, links, link_from, silent = 0, [], 0, None, ""
    ends: dict[str, int] = {}                              # where the last end tag of a silent element stands
    found: dict[int, str] = {}                             # article and main parts
    penal: dict[int, tuple[str, str, bool]] = {}           # elements with a penalty, as markup_weight takes them
    at, size = 0, 0

    def close_block() -> None:
        nonlocal parts, links, size, link_from
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                linked = links + (size - link_from if link_from is not None else 0)
                out.append(Block(text, linked, stack[-1][1], tuple(s[2] for s in stack), stack[-1][0] in PROSE))
        parts, links, size = [], 0, 0
        link_from = None if link_from is None else 0

    def add(text: str) -> None:
        nonlocal size
        if text:
            parts.append(text)
            size += len(text)

    for m in TAG.finditer(page):
        if m.start() < at:
            continue
        if not silent:
            add(page[at:m.start()])
        at = m.end()
        end, name, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if name is None:
            if m[1] and not silent:
                add(m[1])
            continue
        name = name.lower()
        if silent:
            if end and name == silent:
                silent = ""
            continue
        if not end and name in SILENT and not attributes.endswith("/"):
            if name in RAW:                                # its text is no markup: go on behind its end tag
                stop = re.compile(f"</{name}\\s*>", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            elif name == "head":
                if re.search(r"</head\s*>", page[at:at + 200_000], re.I):
                    silent = name
            else:
                if name not in ends:
                    ends[name] = max((e.start() for e in re.finditer(f"</{name}(?=[\\s/>])", page, re.I)), default=-1)
                if ends[name] >= at and closed(page, at, name, {e[0] for e in stack}):
                    silent = name
            continue
        if name == "br":
            add(" ")
        elif name == "a":
            if end:
                links, link_from = (links + size - link_from, None) if link_from is not None else (links, None)
            elif link_from is None:
                link_from = size
        elif name in BLOCK:
            close_block()
            if end:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        break
            else:
                if name in IMPLIED:
                    closes, within = IMPLIED[name]
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in within.split() or name == "p" and stack[i][0] != "p":
                            break
                        if stack[i][0] in closes.split():
                            del stack[i:]
                            break
                elif stack[-1][0] == "p":                  # a paragraph holds no other block
                    stack.pop()
                if name not in VOID and not attributes.endswith("/"):
                    number += 1
                    top = stack[-1]
                    weight = markup_weight(name, attributes, top[3])
                    if name in FOR_TAGS:
                        found[number] = name
                    if weight <= W_AGAINST + W_FOR + W_HINT:
                        penal[number] = name, attributes, top[3]
                    stack.append((name, top[1] + weight, number, top[3] or name in FOR_TAGS))
    if not silent:
        add(page[at:])
    close_block()
    if penal and out:
        back = {n: markup_weight(*penal[n], wrapper=True) - markup_weight(*penal[n]) for n in wrappers(out, found, penal)}
        if back:
            for b in out:
                b.weight += sum(back.get(n, 0.0) for n in b.path)
    return out


def text_features(blocks: list[Block]) -> np.ndarray:
    """Length, links, marks, closing mark, place from the middle, and a constant, each about 0 to 1."""
    n = len(blocks)
    rows = [(min(1.0, math.log1p(len(b.text)) / 7), b.links / max(1, len(b.text)), min(1.0, 10 * len(MARKS.findall(b.text)) / len(b.text)),
             float(b.text[-1] in ".!?…。！？\"”’)"), abs(2 * i / max(1, n - 1) - 1) if n > 1 else 0.0, 1.0) for i, b in enumerate(blocks)]
    return np.array(rows).reshape(-1, FEATURES)


FEATURES = 6


def train(x: np.ndarray, y: np.ndarray, steps: int = 500, rate: float = 1.0, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression by gradient descent, the two classes weighted alike."""
    weights = np.zeros(FEATURES)
    if not len(y) or y.min() == y.max():
        return weights
    w = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y == 0).sum())
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ weights))
        weights -= rate * (x.T @ (w * (p - y)) + decay * weights)
    return weights


def fit(pages: DataFrame, html_col: str = "html") -> np.ndarray:
    """Weights of the text model, from at most SAMPLE_PAGES pages and SAMPLE_BLOCKS of their blocks."""
    # a threshold on the row's hash leaves a little more than enough, so that no task gathers more than the sample
    n, mark = pages.count(), F.pmod(F.xxhash64(*[col(pages, c) for c in pages.columns]), F.lit(1 << 40))
    source = pages.select(col(pages, html_col).alias("h"), mark.alias("m")).where("h IS NOT NULL")
    share = min(1.0, (1.2 * SAMPLE_PAGES + 50) / max(1, n))
    sample = source.where(F.col("m") <= int(share * (1 << 40))).orderBy("m").limit(SAMPLE_PAGES).select("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows: list = []
            labels: list[int] = []
            for page in b.column(0).to_pylist():
                found = blocks_of(page)
                f = text_features(found)
                for i, block in enumerate(found):
                    if abs(block.weight) >= W_FOR:      # labelled by the markup
                        rows.append(f[i].tolist())
                        labels.append(int(block.weight > 0))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int64())], ["x", "y"])

    made = arrow_map(sample, run, "x array<double>, y long").orderBy(F.xxhash64("x", "y"), "x", "y").limit(SAMPLE_BLOCKS).toArrow()
    return train(np.array(made["x"].to_pylist(), float).reshape(-1, FEATURES), made["y"].to_numpy().astype(float))


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: neighbours in page order, and neighbours under one parent, by their distance in the DOM."""
    out: dict[tuple[int, int], float] = {}

    def distance(a: tuple[int, ...], b: tuple[int, ...]) -> int:
        same = 0
        for x, y in zip(a, b):
            if x != y:
                break
            same += 1
        return len(a) + len(b) - 2 * same

    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            out[i - 1, i] = W_SMOOTH / (1 + distance(blocks[i - 1].path, b.path))
        parent = b.path[-2] if len(b.path) > 1 else -1
        if parent in last and last[parent] < i - 1:
            j = last[parent]
            out[j, i] = W_SMOOTH / (1 + distance(blocks[j].path, b.path))
        last[parent] = i
    return [(i, j, w) for (i, j), w in out.items()]


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise the terminal costs plus the weights of edges between different labels; True where the node
    stays with the source. ``odds`` is the source capacity less the sink capacity of each node."""
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:                                            # settled nodes hand their edges on as terminal capacities
        i = todo.popleft()
        if label[i] is None and abs(odds[i]) >= sum(near[i].values()) and (odds[i] != 0 or not near[i]):
            label[i] = odds[i] > 0
            for j, w in near[i].items():
                odds[j] += w if label[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    open_nodes = [i for i in range(n) if label[i] is None]
    if open_nodes:
        for i in max_flow(odds, near, open_nodes):
            label[i] = True
    return [bool(x) for x in label]


def max_flow(odds: list[float], near: list[dict[int, float]], nodes: list[int]) -> set[int]:
    """The source side after a maximum flow (shortest augmenting paths, one search for all paths of equal length)."""
    tiny = 1e-9
    supply = {i: odds[i] for i in nodes if odds[i] > tiny}
    demand = {i: -odds[i] for i in nodes if odds[i] < -tiny}
    rest = {i: dict(near[i]) for i in nodes}               # residual capacities, both directions of each edge
    while True:
        level = {i: 0 for i in supply}
        queue = deque(supply)
        while queue:
            i = queue.popleft()
            for j, w in rest[i].items():
                if w > tiny and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not any(i in level for i in demand):
            return set(level)
        left = {i: iter(list(rest[i])) for i in level}
        for s in list(supply):
            path = [s]
            while path and s in supply:
                i = path[-1]
                if i in demand:
                    push = min([supply[s], demand[i], *(rest[a][b] for a, b in zip(path, path[1:]))])
                    for a, b in zip(path, path[1:]):
                        rest[a][b] -= push
                        rest[b][a] += push
                    for of, k in ((supply, s), (demand, i)):
                        of[k] -= push
                        if of[k] <= tiny:
                            del of[k]
                    cut = next((k for k, (a, b) in enumerate(zip(path, path[1:])) if rest[a][b] <= tiny), None)
                    if cut is not None:
                        path = path[:cut + 1]
                    continue
                step = next((j for j in left[i] if rest[i][j] > tiny and level.get(j) == level[i] + 1), None)
                if step is None:
                    path.pop()
                else:
                    path.append(step)


def main_text(page: str | None, weights: np.ndarray) -> str:
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    looks = np.clip(text_features(blocks) @ weights, -W_TEXT, W_TEXT)
    # log-odds z: -log(1 - p) less -log(p) is z itself, the difference of the two terminal capacities
    odds = [b.weight + (W_PROSE if b.prose else 0.0) + float(t) for b, t in zip(blocks, looks)]
    return "\n".join(b.text for b, keep in zip(blocks, minimum_cut(odds, edges_of(blocks))) if keep)


def extract(pages: DataFrame, weights: np.ndarray, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` without the html, with its main text (a column of that name is replaced)."""
    names = [c for c in pages.columns if c != html_col and c.lower() != out_col.lower()]
    source = pages.select(*[col(pages, c) for c in names], col(pages, html_col))
    schema = pages.select([col(pages, c) for c in names]).schema.add(out_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [main_text(p, weights) for p in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*names, out_col])

    return arrow_map(source, run, schema)


def op3_extract(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out = extract(pages, fit(pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
