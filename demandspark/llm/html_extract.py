"""Main text of web pages by a recurrent labeller over the page's sequence of text blocks."""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.blocks import map_blocks
from demandspark.llm.common import sent

SPACES = re.compile("[\x20\x09-\x0d]+")
#: What stands in a tag behind its name. A quote opens a value only after "="; elsewhere it is a character like others.
MORE = r"""(?:[^>=/]++|/(?!>)|=\s*+(?:"[^"]*"|'[^']*'|(?=>)|[^\s>"'][^\s>]*+))*+"""
TAG = rf"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>{MORE})(?P<empty>/?)>"
COMMENT = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
TOKEN = re.compile(rf"{COMMENT}|<(?P<raw>script|style|noscript|template)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|{TAG}|<[!?/][^>]*>",
                   re.S | re.I)
COMMENTS = re.compile(COMMENT, re.S)
UNCLOSED, NAME = re.compile(r"=\s*\Z"), re.compile(r"<(?!(?i:script|style|noscript|template)[\s/])[a-zA-Z][^\s/>]{0,200}+(?=[\s/])")
IN_SVG = re.compile(f"{COMMENT}|{TAG}", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre section
    select summary table tbody td textarea tfoot th thead title tr ul""".split())
VOID = frozenset(("hr",))
#: Elements of an svg that hold others, and tags that browsers take out of an svg even if its end tag is missing.
SVG_BOXES = frozenset(("svg", "foreignobject", "desc", "title"))
NOT_SVG = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr
    ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
#: A start tag ends an open element of these kinds, up to the container named.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
IN_P = frozenset(("label", "button", "select", "option", "optgroup", "textarea"))

#: Sizes of the hashed parts of a block's vector, and of its plain numbers.
PATH, NEAR, WORDS, NUMBERS = 96, 48, 24, 8
WIDTH = PATH + NEAR + WORDS + NUMBERS
HIDDEN = 16
#: Pages of the fit, blocks a page of the fit may have, copies with changed containers, passes.
FIT_PAGES, FIT_BLOCKS, FIT_COPIES, EPOCHS = 300, 150, 3, 12
#: Open elements around all blocks of a page of the fit, added up.
FIT_DEPTH = 20_000
#: A label for the fit: what stands in these is boilerplate, what else stands in those is main text.
UNWANTED = frozenset("""head nav header footer aside form button select textarea menu dialog ad ads advert advertisement banner sponsor
    sponsored promo sidebar cookie consent notice popup modal comment comments reply replies related share social newsletter subscribe
    breadcrumb breadcrumbs pagination login search widget""".split())
WANTED = frozenset(("article", "main"))
#: Containers that copies of the fit's pages get, so that the labeller knows more than one page design.
MAIN_BOXES = (("article",), ("main",), ("main", "article"), ("div", "id:content"), ("div", "class:post", "class:body"), ("section", "class:entry"),
              ("div", "class:article"), ("div", "id:main"), ("div", "class:story"), ("div",))
OTHER_BOXES = (("nav",), ("header",), ("footer",), ("aside",), ("form",), ("div", "class:ad"), ("div", "class:advert"), ("div", "class:banner"),
               ("div", "class:menu"), ("ul", "class:nav"), ("div", "class:sidebar"), ("div", "id:sidebar"), ("div", "class:footer"),
               ("div", "class:header"), ("div", "class:cookie", "class:notice"), ("div", "class:sponsored"), ("div", "class:related"),
               ("section", "class:comments"), ("div", "id:comments"), ("div", "class:comment"), ("div", "class:newsletter"), ("div", "class:promo"))


class Node:
    """An open element: its labels, those around it, and what the network reads of the way to it, carried from its parent."""
    __slots__ = ("labels", "parent", "depth", "sums", "unwanted", "wanted")

    def __init__(self, labels: tuple[str, ...], parent: Node | None):
        self.labels, self.parent = labels, parent
        self.depth = 0 if parent is None else parent.depth + 1
        self.sums = np.zeros(PATH, np.float32) if parent is None else parent.sums.copy()
        for part in labels:
            h = crc32(part.encode())
            self.sums[h % PATH] += 1.0 if h & 0x10000 else -1.0
        names = [part.split(":", 1)[-1] for part in labels]
        self.unwanted = parent is not None and parent.unwanted or "hidden" in names or bool(UNWANTED.intersection(names))
        self.wanted = parent is not None and parent.wanted or bool(WANTED.intersection(names))


class Block:
    """A stretch of text between block tags: its words joined, the innermost open element, characters in links."""

    def __init__(self, text: str, path: Node | tuple[tuple[str, ...], ...], linked: int):
        self.text, self.linked = text, linked
        if not isinstance(path, Node):
            node = Node((), None)
            for labels in path:
                node = Node(labels, node)
            path = node
        self.node = path

    @property
    def path(self) -> tuple[tuple[str, ...], ...]:
        """Labels of the open elements from outermost."""
        out, node = [], self.node
        while node.parent is not None:
            out.append(node.labels)
            node = node.parent
        return tuple(reversed(out))


class Tags:
    """Finds markup in a page without trying every "<" up to the page's end.

    A tag can fail to match only where no ">" follows, or where a value's quote is never closed, which is the
    last quote of its kind on the page. Starts that must run into that quote, with nothing between that could
    open a value or end the tag, are not tried again.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        #: Unclosed quotes with the place of the "=" before each.
        self.open = sorted((at, page.rfind("=", 0, at)) for at in (page.rfind(q) for q in "\"'") if at > 0 and UNCLOSED.search(page, max(0, at - 200), at))
        self.next = {c: -1 for c in ">=\"'"}

    def _find(self, c: str, at: int) -> int:
        """The next ``c`` at or behind ``at``; asked in rising order, so that the page is read once."""
        if -1 < self.next[c] < at or self.next[c] == -1:
            found = self.page.find(c, at)
            self.next[c] = found if found >= 0 else len(self.page)
        return self.next[c]

    def _hopeless(self, at: int) -> bool:
        for quote, equals in self.open:
            if at < equals:
                name = NAME.match(self.page, at)
                other = "'" if self.page[quote] == '"' else '"'
                return (name is not None and name.end() <= equals and self._find(">", at) > quote and self._find("=", at) == equals
                        and self._find(self.page[quote], at) == quote and self.page.find(other, quote) < 0)
        return False

    def search(self, pattern: re.Pattern, at: int) -> re.Match | None:
        """The first match at or behind ``at``; the pattern's matches begin with "<"."""
        failed = False
        while (at := self.page.find("<", at)) >= 0:
            if at > self.last:
                return COMMENTS.search(self.page, at)
            if not (failed and self._hopeless(at)):
                if found := pattern.match(self.page, at):
                    return found
                failed = True
            at += 1
        return None


def _labels(tag: str, more: str) -> tuple[str, ...]:
    found = [tag]
    if more and ("=" in more or "hidden" in more):
        for name, value in ATTRIBUTE.findall(more):
            name = name.lower()
            if name in ("hidden", "aria-hidden"):
                if value.strip("\"'").lower() != "false":
                    found.append("hidden")
            else:
                found += [f"{name}:{part}" for part in re.split(r"[\s_-]+", value.strip("\"'").lower()) if part]
    return tuple(found)


def _svg_end(tags: Tags, at: int) -> int:
    """Where the content of an svg that starts at ``at`` ends: behind its end tag, or before a tag that cannot be in it."""
    boxes = ["svg"]
    while m := tags.search(IN_SVG, at):
        at = m.end()
        if m.re is not IN_SVG or not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag in SVG_BOXES:
            if not m["end"]:
                if not m["empty"]:
                    boxes.append(tag)
            elif tag in boxes:
                while boxes.pop() != tag:
                    pass
                if not boxes:
                    return m.end()
        elif boxes[-1] == "svg" and (tag in NOT_SVG or m["end"] and tag in BLOCKS):
            return m.start()
    return len(tags.page)


def page_blocks(page: str) -> list[Block]:
    """Text blocks in page order, character references decoded, white space made single blanks.

    Comments, scripts, styles, drawings and markup are gone; inline tags and ``br`` do not end a block, and a
    ``br`` counts as white space. Missing end tags are taken as browsers take them: a block ends an
    open paragraph, an item the item before it. Blocks without text are left out.
    """
    out: list[Block] = []
    root, tags = Node((), None), Tags(page)
    stack: list[Node] = []
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        joined = SPACES.sub(" ", "".join(text)).strip(" ")
        if joined:
            out.append(Block(joined, stack[-1] if stack else root, min(linked, len(joined))))
        text.clear()
        linked = 0

    def take(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece)
            text.append(piece)
            if links:
                linked += len(piece)

    def close(i: int) -> None:
        opened.subtract(node.labels[0] for node in stack[i:])
        del stack[i:]

    while m := tags.search(TOKEN, at):
        take(page[at:m.start()])
        at = m.end()
        if m.re is not TOKEN or m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag not in BLOCKS:
            if tag == "a":
                links = 0 if m["end"] else 1
            elif tag == "br":
                text.append(" ")
            elif tag == "svg" and not m["end"] and not m["empty"]:
                at = _svg_end(tags, at)
            continue
        flush()
        if m["end"]:
            if opened[tag] > 0:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].labels[0] == tag))
            continue
        links = 0
        closes, within = ENDS.get(tag, (frozenset(), frozenset()))
        if tag not in IN_P:
            closes, within = closes | {"p"}, within | {"div", "article", "section", "body", "td", "li", "blockquote", "form", "main", "aside"}
        if any(opened[kind] > 0 for kind in closes):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].labels[0] in closes:
                    close(i)
                    if closes <= {"p"}:
                        break
                elif stack[i].labels[0] in within:
                    break
        if tag not in VOID:
            stack.append(Node(_labels(tag, m["more"]), stack[-1] if stack else root))
            opened[tag] += 1
    take(page[at:])
    flush()
    return out


def weak_label(path: tuple[tuple[str, ...], ...]) -> int:
    """1 main text, 0 boilerplate, -1 unknown, from the names of the open elements."""
    names = [part.split(":", 1)[-1] for element in path for part in element]
    return 0 if UNWANTED.intersection(names) or "hidden" in names else 1 if WANTED.intersection(names) else -1


def block_label(block: Block) -> int:
    """``weak_label`` of a block's path, as its element carries it."""
    return 0 if block.node.unwanted else 1 if block.node.wanted else -1


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: hashed tag path, hashed nearest elements, hashed words, and plain numbers."""
    out = np.zeros((len(blocks), WIDTH))
    for i, b in enumerate(blocks):
        row = out[i]
        row[:PATH] = b.node.sums
        near = (b.node, b.node.parent) if b.node.parent is not None else (b.node,)
        for depth, node in enumerate(near):
            for part in node.labels:
                h = crc32(f"{depth}{part}".encode())
                row[PATH + h % NEAR] += 1.0 if h & 0x10000 else -1.0
        words = b.text.lower().encode().split()
        n = len(words)
        h = np.fromiter(map(crc32, words), np.int64, n)
        row[PATH + NEAR:PATH + NEAR + WORDS] = np.bincount(h % WORDS, np.where(h & 0x10000, 1.0, -1.0), WORDS) / max(1, n)
        size = len(b.text)
        ends = sum(map(b.text.count, ".,;!?"))
        row[-NUMBERS:] = (np.log1p(n) / 5, b.linked / size, min(1.0, 10 * ends / size), float(b.text[-1] in ".!?:"), b.node.depth / 10,
                          float(i == 0), float(i == len(blocks) - 1), i / len(blocks))
    return out


class BiLstm:
    """Bidirectional LSTM with one hidden layer and a logistic output, in numpy."""

    def __init__(self, width: int = WIDTH, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for way in "fb":
            self.p["W" + way] = rng.normal(0, 0.15, (width + hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden:2 * hidden] = 1.0  # remember at first
            self.p["c" + way] = bias
        self.p["V"], self.p["v"] = rng.normal(0, 0.3, 2 * hidden), np.zeros(1)

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        steps, n, width = x.shape
        H, W, bias = self.hidden, self.p["W" + way], self.p["c" + way]
        from_x = x @ W[:width] + bias
        h, c = np.zeros((n, H)), np.zeros((n, H))
        out, cache = np.zeros((steps, n, H)), []
        for t in (range(steps) if way == "f" else range(steps - 1, -1, -1)):
            z = from_x[t] + h @ W[width:]
            gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * H], -30, 30)))
            i, f, o, g = gates[:, :H], gates[:, H:2 * H], gates[:, 2 * H:], np.tanh(z[:, 3 * H:])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            if keep:
                cache.append((t, h, c, i, f, o, g, tc, m))
            h, c = m * o * tc + (1 - m) * h, m * new_c + (1 - m) * c
            out[t] = h
        return out, cache

    def probability(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """``x`` steps by pages by width, ``mask`` steps by pages; probability of main text."""
        both = np.concatenate([self._run(x, mask, way, False)[0] for way in "fb"], axis=2)
        return 1 / (1 + np.exp(-np.clip(both @ self.p["V"] + self.p["v"], -30, 30)))

    def gradients(self, x: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted logistic loss and its gradients through time."""
        H, width = self.hidden, x.shape[2]
        runs = {way: self._run(x, mask, way, True) for way in "fb"}
        both = np.concatenate([runs[way][0] for way in "fb"], axis=2)
        p = 1 / (1 + np.exp(-np.clip(both @ self.p["V"] + self.p["v"], -30, 30)))
        total = max(weight.sum(), 1e-9)
        loss = float(-(weight * (target * np.log(p + 1e-12) + (1 - target) * np.log(1 - p + 1e-12))).sum() / total)
        d = weight * (p - target) / total
        grad = {"V": np.einsum("tn,tnh->h", d, both), "v": np.array([d.sum()])}
        for k, way in enumerate("fb"):
            W = self.p["W" + way]
            gW, gc = np.zeros_like(W), np.zeros(4 * H)
            dh, dc = np.zeros((x.shape[1], H)), np.zeros((x.shape[1], H))
            for t, h, c, i, f, o, g, tc, m in reversed(runs[way][1]):
                dh = dh + d[t][:, None] * self.p["V"][k * H:(k + 1) * H]
                do = m * dh * tc
                dnew = m * (dc + dh * o * (1 - tc ** 2))
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), do * o * (1 - o), dnew * i * (1 - g ** 2)], axis=1)
                gW[:width] += x[t].T @ dz
                gW[width:] += h.T @ dz
                gc += dz.sum(0)
                dh, dc = (1 - m) * dh + dz @ W[width:].T, dnew * f + (1 - m) * dc
            grad["W" + way], grad["c" + way] = gW, gc
        return loss, grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = 32, rate: float = 0.02, seed: int = 0) -> float:
        """Adam over batches of pages of similar length; labels below 0 are unknown and weigh nothing."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, loss = 0, 0.0
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        groups = [order[i:i + batch] for i in range(0, len(order), batch)]
        for epoch in range(epochs):
            losses = []
            for k in rng.permutation(len(groups)):
                x, mask = padded([pages[i][0] for i in groups[k]])
                label = np.full(mask.shape, -1.0)
                for j, i in enumerate(groups[k]):
                    label[:len(pages[i][1]), j] = pages[i][1]
                loss, grad = self.gradients(x, mask, np.maximum(label, 0), (label >= 0).astype(float))
                losses.append(loss)
                step += 1
                for name, g in grad.items():
                    g = np.clip(g, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    scale = rate * (1 - epoch / (epochs + 1))
                    self.p[name] -= scale * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)
            loss = float(np.mean(losses))
        return loss


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, sequences))
    x, mask = np.zeros((steps, len(sequences), sequences[0].shape[1])), np.zeros((steps, len(sequences)))
    for j, s in enumerate(sequences):
        x[:len(s), j], mask[:len(s), j] = s, 1.0
    return x, mask


def recast(blocks: list[Block], labels: list[int], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A copy of a labelled page in another design: other containers, and boilerplate put between and after."""
    main = (("html",), ("body",), rng.choice(MAIN_BOXES)) if rng.random() < 0.85 else ()  # or a bare fragment
    out, said, boxes = [], [], {}
    texts = [b.text.split() for b in blocks]

    def boiler(within: tuple) -> None:
        words = rng.choice(texts)
        start = rng.randrange(len(words))
        box = rng.choice(OTHER_BOXES)
        for _ in range(rng.randint(1, 3)):
            inner = rng.choice(((), (("p",),), (("li",),), (("div",),)))
            text = " ".join(words[start:start + rng.randint(1, 25)]) or "x"
            out.append(Block(text, within + (box,) + inner, len(text) if rng.random() < 0.5 else 0))
            said.append(0)

    for b, label in zip(blocks, labels):
        if label == 1:
            inner = next((i + 1 for i, e in enumerate(b.path) if WANTED.intersection(e)), len(b.path))
            out.append(Block(b.text, main + (b.path[inner:] if main or rng.random() < 0.6 else ()), b.linked))
            if rng.random() < 0.06:
                said.append(1)
                boiler(main if rng.random() < 0.7 else main[:2])
                continue
        elif label == 0 and not any("head" in e for e in b.path):
            box = boxes.setdefault(b.path[:3], b.path[2:3] if rng.random() < 0.4 else (rng.choice(OTHER_BOXES),))
            out.append(Block(b.text, b.path[:2] + tuple(box) + b.path[3:], b.linked))
        else:
            out.append(b)
        said.append(label)
    for _ in range(rng.randint(0, 2)):
        boiler((("html",), ("body",)))
    return out, said


def fit(pages: DataFrame, page_id: str = "page_id", html_column: str = "html", fit_pages: int = FIT_PAGES, copies: int = FIT_COPIES,
        seed: int = 0) -> BiLstm | None:
    """A labeller fitted on at most ``fit_pages`` pages, picked by a hash, of at most FIT_BLOCKS blocks and not nested beyond FIT_DEPTH.

    The labels come from element names (``weak_label``), and each page enters once as it is and
    ``copies`` times in other designs. None if no picked page has both kinds of block.
    """
    rows = pages.select(F.xxhash64(F.col(page_id).cast("string")).alias("h"), F.col(html_column).alias("html")).filter("html is not null")
    cut = rows.select("h").orderBy("h").limit(fit_pages).agg(F.max("h")).first()[0]
    if cut is None:
        return None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = [page_blocks(p) for p in part["html"]]
            yield pd.DataFrame({"page": [[(b.text, "\n".join(" ".join(e) for e in b.path), b.linked) for b in page] if len(page) <= FIT_BLOCKS and sum(b.node.depth for b in page) <= FIT_DEPTH else []
                                         for page in found]})

    sample = (rows.filter(F.col("h") <= F.lit(cut)).limit(fit_pages).select("html")
              .mapInPandas(read, "page array<struct<text:string,path:string,linked:int>>").collect())
    rng, made = random.Random(seed), []
    for row in sorted(sample, key=lambda r: crc32(repr(r).encode())):
        blocks = [Block(b.text, tuple(tuple(e.split(" ")) for e in b.path.split("\n")) if b.path else (), b.linked) for b in row.page]
        labels = [block_label(b) for b in blocks]
        if {0, 1} <= set(labels):
            made.append((vectors(blocks), np.array(labels, float)))
            for _ in range(copies):
                other, said = recast(blocks, labels, rng)
                made.append((vectors(other), np.array(said, float)))
    if not made:
        return None
    model = BiLstm(seed=seed)
    model.fit(made)
    return model


def label_pages(pages: list[list[Block]], model: BiLstm | None, batch: int = 128) -> list[np.ndarray]:
    """For each page, which blocks are main text; pages of similar length go through the network together.

    Without a model the element names decide, and unknown blocks are main text.
    """
    if model is None:
        return [np.array([block_label(b) != 0 for b in page], bool) for page in pages]
    out = [np.zeros(0, bool)] * len(pages)
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
    at = 0
    while at < len(order):
        group = order[at:at + max(1, min(batch, 200_000 // len(pages[order[min(at + batch, len(order)) - 1]])))]
        at += len(group)
        p = model.probability(*padded([vectors(pages[i]) for i in group]))
        for j, i in enumerate(group):
            out[i] = p[:len(pages[i]), j] >= 0.5
    return out


def main_text(pages: DataFrame, model: BiLstm | None, page_id: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    The blocks labelled main text, in page order, joined by an empty line. A null page is empty; a page
    without main text gives an empty text; text without any markup is one block. Repeated rows give
    repeated answers; no rows give no rows; other columns are not read. Pages are read whole.
    """
    model_of = sent(pages.sparkSession, model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = model_of()
        for rows in frames:
            found = [page_blocks(p) for p in rows["text"]]
            texts = ["\n\n".join(b.text for b, keep in zip(page, kept) if keep) for page, kept in zip(found, label_pages(found, labeller))]
            yield pd.DataFrame({"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html_column), F.lit("")).alias("text"))
    return map_blocks(rows, run, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")
