"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of elements and of runs of text. For each node the trees estimate whether it holds main text,
from its tag, depth, siblings, the density of its subtree, and what the words in its class, id and role and in those
above it have meant elsewhere: log odds learnt for hashed attribute tokens. Estimates may contradict each other; the
decoder picks the most likely consistent choice: a node that is dropped is dropped with all below it, and a node with
something kept below it is kept.

There are no labelled pages, so the trees learn from pages that mark their article themselves, and from the texts of
those and of unmarked pages put into many other layouts.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm import boosting
from parcelspark.llm.common import batches_of, checkpoint, text_batches

# Elements of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
NEVER_TEXT = frozenset("script style head title noscript template iframe svg object select option button textarea form "
                       "input nav dialog datalist audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 dt dd".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
                  "dt": ("dl",), "dd": ("dl",), "option": ("select",), "p": ()}
# End of fixed values.

#: Pages that the trees are fitted on, at most (those whose contents hash lowest), and layouts made of each; pages are
#: used whole, as many of them as have FIT_NODES nodes together, layouts included.
FIT_PAGES, LAYOUTS, FIT_NODES = 600, 4, 300_000

#: Hashed attribute tokens, and how many sightings on either side their odds are drawn to none by.
TOKENS, PRIOR = 1 << 12, 4.0

_TAG = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"=\s*([\"'])|>")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")

FEATURES = (
    "depth", "text", "nodes", "density", "link_share", "page_share", "place", "siblings", "sibling_place",
    "same_tags", "stops", "content_tag", "other_tag", "is_p", "is_heading", "is_list", "is_table", "is_run",
    "parent_link_share", "parent_density", "paragraphs", "parent_share",
)
NAME_FEATURES = ("least_odds", "most_odds", "least_above", "most_above")


def tags_of(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(begin, end, `/` or ``, tag, attributes) of each tag, comment or declaration (without a tag) of a page.

    One pass: quoted values are stepped over until one is found that never ends; from there on a tag ends at the next
    `>`. A `<` that begins nothing is text.
    """
    at, size, last, quotes = 0, len(source), source.rfind(">"), True
    while (begin := source.find("<", at)) >= 0:
        at = begin + 1
        if source.startswith("<!--", begin) or source.startswith("<![CDATA[", begin):
            mark = "-->" if source[begin + 2] == "-" else "]]>"
            end = source.find(mark, begin + 4)
            at = size if end < 0 else end + 3
            yield begin, at, "", "", ""
            continue
        if begin > last:
            continue
        if source[at] in "!?":
            at = source.find(">", at) + 1
            yield begin, at, "", "", ""
            continue
        slash = "/" if source[at] == "/" else ""
        name = _TAG.match(source, at + len(slash))
        if not name:
            continue
        at = name.end()
        while quotes and not slash:
            stop = _STOP.search(source, at)
            if stop and not stop[1]:
                at = stop.end()
                break
            close = source.find(stop[1], stop.end()) if stop else -1
            if close < 0:
                quotes = False
                at = name.end()
            else:
                at = close + 1
        else:
            at = source.find(">", at) + 1
        yield begin, at, slash, name[0].lower(), "" if slash else source[name.end() : at - 1]


def hashed(name: str) -> int:
    return zlib.crc32(name.encode()) % TOKENS


class Node:
    __slots__ = ("tag", "parent", "names", "children", "place", "depth")

    def __init__(self, tag: str, parent: int, names: frozenset, depth: int, place: int = 0):
        self.tag, self.parent, self.names, self.depth, self.place = tag, parent, names, depth, place
        self.children: list[int] = []


class Open:
    """The open elements of a page: what is asked of them takes no walk through all."""

    def __init__(self, nodes: list[Node]):
        self.nodes = nodes
        self.stack = [0]
        self.solid = [0]  # for each of them, the nearest at or above it that is no inline element
        self.tags: Counter[str] = Counter()
        self.silent = 0  # of them, those whose text never counts

    def push(self, node: int) -> None:
        tag = self.nodes[node].tag
        self.solid.append(self.solid[-1] if tag in INLINE else len(self.stack))
        self.stack.append(node)
        self.tags[tag] += 1
        self.silent += tag in NEVER_TEXT

    def end(self, i: int) -> None:
        """Close what is open from place i on."""
        for node in self.stack[i:]:
            tag = self.nodes[node].tag
            self.tags[tag] -= 1
            self.silent -= tag in NEVER_TEXT
        del self.stack[i:], self.solid[i:]

    def close(self, tag: str) -> None:
        if self.tags[tag]:
            i = len(self.stack) - 1
            while self.nodes[self.stack[i]].tag != tag:
                i -= 1
            self.end(i)

    def make_room(self, tag: str) -> None:
        """End elements that the start of a block-level `tag` ends without an end tag, with what is open in them."""
        bounds = CLOSED_BY_SAME.get(tag)
        i = self.solid[-1]
        while i > 0:
            now = self.nodes[self.stack[i]].tag
            ends_it = now in CLOSED_BY_BLOCK and tag not in VOID and not (now in ("dt", "dd") and tag not in ("dt", "dd"))
            if ends_it or (bounds is not None and now == tag and now != "p"):
                return self.end(i)
            if bounds is None or now in bounds or now not in ("td", "th", "tr", "dt", "dd"):
                return
            i = self.solid[i - 1]


class Page:
    """nodes in page order (0 is the root); runs: (node, text) in page order; breaks: whether a block begins there."""

    def __init__(self, source: str | None):
        self.nodes = [Node("#root", -1, frozenset(), 0)]
        self.runs: list[tuple[int, str]] = []
        self.breaks: list[bool] = []
        self._parse(source or "")

    def _add(self, tag: str, parent: int, names: frozenset, depth: int) -> int:
        brothers = self.nodes[parent].children
        self.nodes.append(Node(tag, parent, names, depth, len(brothers)))
        brothers.append(len(self.nodes) - 1)
        return len(self.nodes) - 1

    def _parse(self, source: str) -> None:
        opened, pending, at = Open(self.nodes), True, 0

        def text(end: int) -> None:
            nonlocal pending
            if end > at and not opened.silent:
                self.runs.append((opened.stack[-1], html.unescape(source[at:end])))
                self.breaks.append(pending)
                pending = False

        for begin, end, slash, tag, attributes in tags_of(source):
            if begin < at:  # inside of raw text
                continue
            text(begin)
            at = end
            if tag and tag not in INLINE:
                pending = True
            if slash:
                opened.close(tag)
            elif tag:
                if tag not in INLINE:
                    opened.make_room(tag)
                if tag in VOID:
                    continue
                names = frozenset(
                    hashed(n) for m in _ATTRIBUTE.finditer(attributes) for n in _NAME.findall((m[2] or m[3] or m[4] or "").lower())
                )
                names |= {hashed(f"={m[4] or m[3] or m[2]}".lower()) for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() in ("role", "itemprop")}
                node = self._add(tag, opened.stack[-1], names, len(opened.stack))
                if attributes.endswith("/") and tag in ("svg", "path"):
                    continue
                opened.push(node)
                if tag in RAW:
                    close = re.compile(rf"</{re.escape(tag)}\b", re.I).search(source, at)
                    at = close.start() if close else len(source)
        text(len(source))

    def text(self, keep: list[bool]) -> str:
        """Text of the runs whose node is kept: white space becomes one space, blocks are joined by one."""
        blocks, now, broken = [], [], False
        for (node, part), fresh in zip(self.runs, self.breaks):
            broken = broken or fresh
            if keep[node]:
                if broken and now:
                    blocks.append("".join(now))
                    now = []
                broken = False
                now.append(part)
        blocks.append("".join(now))
        return " ".join(b for b in (" ".join(x.split()) for x in blocks) if b)

    def split_runs(self) -> None:
        """Give runs of text beside blocks nodes of their own, so that they can be told from their element."""
        mixed = {i for i, n in enumerate(self.nodes) if any(self.nodes[c].tag not in INLINE for c in n.children)}
        runs = []
        for node, part in self.runs:
            if node in mixed and part.strip():
                node = self._add("#run", node, frozenset(), self.nodes[node].depth + 1)
            runs.append((node, part))
        self.runs = runs

    def features(self) -> np.ndarray:
        """One row of FEATURES for each node."""
        nodes, n = self.nodes, len(self.nodes)
        own, own_links, stops, start = [0] * n, [0] * n, [0] * n, [-1] * n
        total = 0
        for node, part in self.runs:
            size = len(part) - part.count(" ") - part.count("\n")
            own[node] += size
            stops[node] += part.count(".") + part.count(",") + part.count(";") + part.count("!") + part.count("?")
            if start[node] < 0:
                start[node] = total
            total += size
        count, paragraphs, links = [1] * n, [0] * n, own_links
        for i, x in enumerate(nodes):
            if x.tag == "a":
                links[i] = own[i]
        chars = own[:]
        for i in range(n - 1, 0, -1):  # children come after their parents
            p = nodes[i].parent
            if nodes[i].tag == "a":
                links[i] = chars[i]
            chars[p] += chars[i]
            stops[p] += stops[i]
            links[p] += links[i]
            count[p] += count[i]
            paragraphs[p] += paragraphs[i] + (nodes[i].tag == "p")
            if start[i] >= 0 and (start[p] < 0 or start[i] < start[p]):
                start[p] = start[i]
        kinds = [Counter(nodes[c].tag for c in x.children) for x in nodes]
        out = []
        for i, x in enumerate(nodes):
            p = max(0, x.parent)
            brothers = len(nodes[p].children)
            out.append((
                x.depth, log(1 + chars[i]), log(count[i]), chars[i] / count[i], links[i] / (1 + chars[i]),
                chars[i] / (1 + total), max(0, start[i]) / (1 + total), log(1 + brothers), x.place / max(1, brothers),
                log(1 + kinds[p][x.tag]), 100 * stops[i] / (1 + chars[i]), x.tag in ("article", "main"),
                x.tag in ("header", "footer", "aside", "menu"), x.tag == "p", x.tag in ("h1", "h2", "h3", "h4"),
                x.tag in ("ul", "ol", "li", "dl"), x.tag in ("table", "tr", "td", "th"), x.tag == "#run",
                links[p] / (1 + chars[p]), chars[p] / count[p], paragraphs[i], chars[i] / (1 + chars[p]),
            ))
        return np.array(out, float)

    def shape(self) -> tuple[np.ndarray, list[frozenset]]:
        """Parent and attribute tokens of each node."""
        return np.array([n.parent for n in self.nodes], np.int32), [n.names for n in self.nodes]

    def decode(self, p: np.ndarray) -> list[bool]:
        """The most likely consistent choice: which nodes are kept."""
        p = np.clip(p, 1e-4, 1 - 1e-4)
        kept, dropped = np.log(p), np.log(1 - p)
        best = kept.copy()
        for i in range(len(self.nodes) - 1, 0, -1):
            up = self.nodes[i].parent
            best[up] += max(best[i], dropped[i])
            dropped[up] += dropped[i]
        keep = [False] * len(self.nodes)
        keep[0] = True
        for i in range(1, len(self.nodes)):
            keep[i] = keep[self.nodes[i].parent] and bool(best[i] >= dropped[i])  # in doubt, text stays
        return keep


def name_features(parents: np.ndarray, names: list[frozenset], odds: np.ndarray) -> np.ndarray:
    """NAME_FEATURES of nodes in page order: least and greatest odds of their own attribute tokens, and of those above
    them; 0 without any."""
    out = np.zeros((len(parents), 4))
    for i, tokens in enumerate(names):
        if i:
            up = out[parents[i]]
            out[i, 2], out[i, 3] = min(up[0], up[2]), max(up[1], up[3])
        if tokens:
            own = [odds[t] for t in tokens]
            out[i, 0], out[i, 1] = min(0.0, *own), max(0.0, *own)
    return out


@dataclass(frozen=True)
class Judge:
    """Trees over FEATURES and NAME_FEATURES, and the odds of attribute tokens."""

    trees: boosting.Trees
    odds: np.ndarray

    def features(self, page: Page) -> np.ndarray:
        return np.hstack([page.features(), name_features(*page.shape(), self.odds)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.trees.probability(x)


def _main_nodes(page: Page) -> list[bool] | None:
    """Whether a node is in the article, for pages that mark theirs, and in no menu, header, footer or sidebar element
    of it; None for others."""
    inside, found = [False] * len(page.nodes), False
    for i, x in enumerate(page.nodes):
        up = inside[x.parent] if i else False
        mark = x.tag in ("article", "main") or hashed("=articlebody") in x.names
        found = found or mark
        inside[i] = (up or mark) and x.tag not in ("aside", "footer", "header", "menu")
    return inside if found and any(inside[n] and t.strip() for n, t in page.runs) else None


def _dense_nodes(page: Page) -> list[bool]:
    """For pages without a mark: nodes of prose, by the density rule: at least 40 characters, a fifth of them in links
    at most, and a stop in them. They serve as main text of made layouts only."""
    x = page.features()
    chars, links, stops = (x[:, FEATURES.index(f)] for f in ("text", "link_share", "stops"))
    return ((chars >= log(41)) & (links <= 0.2) & (stops > 0)).tolist()


_MARK = "\x01"  # begins main text in made layouts


def _layout(draw: np.random.Generator, main: list[str], other: list[str]) -> str:
    """A page with these blocks of main and other text in some layout; main text carries a mark."""
    pick = lambda *some: some[draw.integers(len(some))]
    maybe = lambda p: draw.random() < p
    words = lambda n: " ".join((pick(*other) if other else "more").split()[:n]) or "more"
    sentence = lambda: pick(*(main + other))[: int(draw.integers(20, 300))]
    esc = html.escape

    def named(tag: str, name: str, body: str) -> str:
        name += pick("", "", "-1", " box", "-wrap", " col-2")
        return f'<{tag} {pick("class", "id")}="{name}">{body}</{tag}>'

    def link_list(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="#">{esc(words(2))}</a></li>' for _ in range(n)) + "</ul>"

    def aside() -> str:
        kind = draw.integers(8)
        prose = f"<p>{esc(sentence())}</p>"
        if kind == 0:
            return named("div", pick("ad", "ads", "advert", "sponsored", "promo", "banner"), pick(prose, esc(words(8))))
        if kind == 1:
            return f"<aside>{pick(prose, link_list(4), '<h3>' + esc(words(2)) + '</h3>' + prose)}</aside>"
        if kind == 2:
            return named("div", pick("sidebar", "widget", "side", "rail"), f"<h3>{esc(words(2))}</h3>" + pick(prose, link_list(5)))
        if kind == 3:
            return named("div", pick("cookie", "notice", "consent", "newsletter", "alert"), prose)
        if kind == 4:
            return named("div", pick("related", "share", "social", "recommended"), link_list(4))
        if kind == 5:
            return named("div", pick("breadcrumb", "pagination", "menu", "tags"), " ".join(f'<a href="#">{esc(words(1))}</a>' for _ in range(4)))
        if kind == 6:
            return f"<form><p>{esc(words(5))}</p><input></form>"
        return f'<div>{link_list(6)}</div>'

    wrap = draw.integers(3)
    blocks = []
    for i, b in enumerate(main):
        text = _MARK + esc(b)
        if maybe(0.08):  # what belongs to an article, whatever its name says
            blocks.append(pick(
                f"<figure><img><figcaption>{text}</figcaption></figure>", f"<address>{text}</address>",
                named(pick("p", "div"), pick("byline", "author", "meta", "date", "tags"), text),
                named("div", pick("reviews", "review", "caption", "legal", "summary", "quote"), f"<p>{text}</p>"),
                f"<table><tr><td>{text}</td></tr></table>",
            ))
            continue
        if i == 0 and maybe(0.5):
            blocks.append(f"<h1>{_MARK}{esc(b[:60])}</h1>")
        blocks.append(
            f"<p>{text}</p>" if wrap == 0 or (wrap == 2 and maybe(0.7)) else f"<div>{text}</div>" if wrap == 2
            else f"{text}<br><br>" if maybe(0.2) else pick(f"<p>{text}</p>", f"<h2>{text[:40]}</h2>", f"<ul><li>{text}</li></ul>",
                                                           f"<blockquote><p>{text}</p></blockquote>", f"<p><b>{text}</b></p>")
        )
        if maybe(0.12):
            blocks.append(aside())
    body = "".join(blocks)
    kind = draw.integers(5)
    if kind == 0:
        body = f"<article>{body}</article>"
    elif kind == 1:
        body = f"<main>{body}</main>"
    elif kind == 2:
        body = named(pick("div", "section"), pick("content", "main", "post", "entry", "story", "article", "text"), body)
    elif kind == 3:
        body = f'<div class="{pick("c", "x1", "col", "row", "inner")}">{body}</div>'
    else:
        body = f"<div>{body}</div>"
    if maybe(0.4):
        one = lambda: named("div", pick("comment", "reply"), f"<p>{esc(sentence())}</p>")
        body += named(pick("div", "section", "ol"), pick("comments", "discussion", "respond"), f"<h3>{esc(words(2))}</h3>" + "".join(one() for _ in range(draw.integers(1, 5))))
    around = [aside() for _ in range(draw.integers(0, 4))]
    cut = int(draw.integers(len(around) + 1))
    body = "".join(around[:cut]) + body + "".join(around[cut:])
    for _ in range(draw.integers(0, 3)):
        body = f'<div class="{pick("wrap", "page", "container", "w")}">{body}</div>'
    head = pick("", f"<header><h2>{esc(words(3))}</h2>{pick('', link_list(4))}</header>", named("div", pick("header", "topbar"), esc(words(6))))
    top = pick("", f"<nav>{link_list(5)}</nav>", named("div", pick("nav", "menu", "navbar"), link_list(6)))
    foot = pick("", f"<footer>&copy; {esc(sentence())}</footer>", named("div", pick("footer", "copyright", "legal"), f"<p>{esc(sentence())}</p>"))
    return f"<html><head><title>{esc(words(4))}</title></head><body>{head}{top}{body}{foot}</body></html>"


@dataclass(frozen=True)
class Example:
    """A page that trees are fitted on: features, parents and attribute tokens of its nodes, and for those with text
    whether some of it is main text (others: -1)."""

    x: np.ndarray
    parents: np.ndarray
    names: list[frozenset]
    y: np.ndarray


def _example(page: Page, main: list[bool]) -> Example:
    y = np.full(len(page.nodes), -1)
    for (node, text), is_main in zip(page.runs, main):
        if text.strip():
            y[node] = max(y[node], int(is_main))
    parents, names = page.shape()
    for i in range(len(parents) - 1, 0, -1):
        y[parents[i]] = max(y[parents[i]], y[i])
    return Example(page.features().astype(np.float32), parents, names, y)


def examples(source: str | None, seed: int) -> list[Example]:
    """A page as it is if it marks its article, and other layouts of its contents."""
    page = Page(source)
    page.split_runs()
    marked = _main_nodes(page)
    inside = marked or _dense_nodes(page)
    texts = [(" ".join(t.split()), inside[n]) for n, t in page.runs if t.strip()]
    main, other = [t for t, m in texts if m], [t for t, m in texts if not m] or ["more"]
    out = [_example(page, [inside[n] for n, _ in page.runs])] if marked else []
    for i in range(LAYOUTS if main else 0):
        made = Page(_layout(np.random.default_rng([seed & 0x7FFFFFFF, i]), main, other))
        made.split_runs()
        out.append(_example(made, [_MARK in t for _, t in made.runs]))
    return out


def fit(pages: list[Example]) -> Judge:
    """Odds of attribute tokens (of a node with text, counted on nodes with text), then trees."""
    seen = np.zeros((2, TOKENS))
    for page in pages:
        for names, y in zip(page.names, page.y):
            if y >= 0:
                for token in names:
                    seen[y, token] += 1
    total = seen.sum(1, keepdims=True) + 1
    odds = np.log((seen[1] + PRIOR) / (seen[0] + PRIOR)) if pages else np.zeros(TOKENS)
    odds = np.where(seen.sum(0) > 0, odds - np.log(total[1] / total[0]) * PRIOR / (seen.sum(0) + PRIOR), 0.0)
    x = [np.hstack([p.x, name_features(p.parents, p.names, odds)])[p.y >= 0] for p in pages]
    y = [p.y[p.y >= 0] for p in pages]
    width = len(FEATURES) + len(NAME_FEATURES)
    x, y = (np.concatenate(x), np.concatenate(y)) if pages else (np.zeros((0, width)), np.zeros(0))
    return Judge(boosting.fit(x.astype(float), y.astype(float), rounds=50, depth=5, rate=0.25), odds)


def train(pages: DataFrame, rows: int = FIT_PAGES, nodes: int = FIT_NODES) -> Judge:
    """Learn from at most `rows` pages, those whose contents hash lowest, and of these as many as have `nodes` nodes
    together with their layouts (the first whatever it has). Pages are used whole.

    The hashes are filtered by a bound that leaves about eight times as many as are needed, so that tasks send few of
    them on, and only the pages chosen are read again. Without any page that has text, nothing is learnt and all text
    outside of scripts, forms and the like counts as main text.
    """
    whole = pages.where("html is not null").select("html", F.xxhash64("html").alias("h"))
    hashes = checkpoint(whole.select("h"))
    share = min(1.0, 8 * rows / max(1, hashes.count()))
    bound = (1 << 63) - 1 if share == 1 else int(share * (1 << 64)) - (1 << 63)
    chosen = hashes.where(F.col("h") <= bound).distinct().orderBy("h").limit(rows)
    # `rows` hashes at most, so the table is small whatever the input
    sample = whole.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("html", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, h in zip(batch.column(0), batch.column(1).to_pylist()):
                found = examples(source.as_py(), h)
                data = pickle.dumps([(e.x, e.parents, e.names, e.y) for e in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h]), pa.array([sum(len(e.y) for e in found)]), pa.array([data], pa.binary())], ["h", "n", "data"]
                )

    with batches_of(pages.sparkSession, 100):
        made = checkpoint(sample.repartition(16, "h").mapInArrow(run, "h long, n long, data binary"))
    so_far = F.sum("n").over(Window.orderBy("h"))  # `rows` rows at most
    kept = made.select("h", "n").withColumn("_all", so_far).where((F.col("_all") <= nodes) | (F.col("_all") == F.col("n")))
    found = made.join(F.broadcast(kept.select("h")), "h").select("h", "data").collect()
    found.sort(key=lambda r: r["h"])
    return fit([Example(*e) for r in found for e in pickle.loads(bytes(r["data"]))])


def extract_page(source: str | None, judge: Judge) -> str:
    return extract_many([source], judge)[0]


def extract_many(sources: list[str | None], judge: Judge) -> list[str]:
    """Main text of each page; all nodes of the pages are scored together."""
    pages = [Page(s) for s in sources]
    for page in pages:
        page.split_runs()
    features = [judge.features(page) for page in pages]
    p = judge.probability(np.concatenate(features)) if features else np.zeros(0)
    out, at = [], 0
    for page, x in zip(pages, features):
        out.append(page.text(page.decode(p[at : at + len(x)])))
        at += len(x)
    return out


def extract(pages: DataFrame, judge: Judge) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html).

    A null or empty page, and one without main text, gives an empty text. Whole pages are read. Rows and repeats
    stay, other columns are ignored, an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 100):
                part = batch.slice(at, 100)
                found = extract_many(part.column(2).to_pylist(), judge)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = text_batches(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
