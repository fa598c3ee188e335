"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is the path of tags with class and id from the
root, so elements that look alike on several pages are one node. A node's importance says how much
pages differ in it:

* content of a leaf: 1 minus the mean, over the texts found in it, of the entropy of a text's
  distribution over the host's pages that have the leaf, in units of the logarithm of their number. A
  text on all of them gives 0, texts of their own on each page give 1;
* presentation of an inner node: the entropy, in the same units, of the ways in which its children are
  laid out;
* a branch: its presentation, weighted 1 - GAMMA, and the mean of the leaves below, weighted GAMMA.

Branches below a threshold go from every page of the host, also within ``article`` and ``main``. Pages
that are copies of each other count once. Branches on one or two pages say nothing about importance: what
two pages share may as well be an article that was changed a little, and all of it would go.
What the markup itself names is respected: elements such as ``nav`` or ``footer``, or with a class like
``ad``, go on any host. ``article`` and ``main`` shift what importance a leaf needs: on a page that has
one, leaves outside need a higher importance, and go where nothing is known about them. Inside, only
classes that name nothing but a foreign part (WITHIN) decide; the others, such as ``entry-header``, are
a prior: leaves below them need the higher importance too, but stay where nothing is known.

Elements nest MOST_LEVELS deep; those below become siblings, as in browsers, and keep their text. So a
page takes time in proportion to its length, however deep it is nested.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.common import map_rows, written

THRESHOLD = 0.35
# What a leaf outside article and main needs on a page that has one of them, and a doubtful one within.
OUTSIDE = 0.8
GAMMA = 0.9
# Different pages that a branch has to be on, so that what they share can be told from near copies.
LEAST_PAGES = 3
MOST_LEVELS = 512

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp".split())
# Elements that are never part of an article, and words of class, id or role that say the same.
NOISE_TAGS = frozenset(
    "nav footer aside form dialog button select option head menu object canvas".split()
)
NOISE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav\w*|breadcrumbs?"
    r"|footer|(?<!entry.)(?<!post.)(?<!article.)(?<!story.)header|masthead|cookies?|consent|notice|popup|modal|overlay|newsletter|subscribe"
    r"|share|sharing|social|related|recommended|comments?|replies|disqus|respond|widget|toolbar"
    r"|login|search(?!.results?\b)|copyright|legal|pagination|pager)(?:$|[\s_-])",
    re.IGNORECASE,
)
# The whole names that say so of a part of an article too, and of an article as a whole.
WITHIN = re.compile(
    r"(?<!\S)(?:ads?|advert\w*|ad[_-](?:slot|unit|banner|box|container)|sponsor(?:ed)?|promo(?:tion)?"
    r"|comments?(?:[_-](?:list|area|section|thread|form|body))?|replies|disqus(?:_thread)?|respond"
    r"|newsletter(?:[_-](?:signup|form|box))?|subscribe|cookies?(?:[_-](?:notice|banner|bar))?"
    r"|related(?:[_-](?:posts|articles|stories|links))?|recommended|breadcrumbs?|side-?bar"
    r"|nav|navbar|navigation|menu|pagination|pager|sharing|share[_-](?:buttons|bar|links)"
    r"|social[_-](?:links|share|bar)|popup|modal|toolbar)(?!\S)",
    re.IGNORECASE,
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section"
    " summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+>|[^>]*>?)"
    r"|[^<]+|<",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]*)", re.IGNORECASE)
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.IGNORECASE)


def host_of(url: str | None) -> str | None:
    found = HOST.match(url.strip()) if url else None
    return found.group(1).lower() if found else None


def attributes(rest: str) -> dict[str, str]:
    """Of a start tag, by lower-case name; the first of a name counts, as in browsers."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), "".join(values))
    return found


def hidden(given: dict[str, str]) -> bool:
    """Whether the attributes hide an element; ``until-found`` is text that readers can search."""
    return (
        given.get("hidden", "until-found").strip().lower() != "until-found"
        or given.get("aria-hidden", "").strip().lower() == "true"
        or [d.lower() for d in DISPLAY.findall(given.get("style", ""))][-1:] == ["none"]
    )


class Node:
    """An open element. ``block`` is the nearest one that is a block, itself included."""

    __slots__ = ("tag", "path", "noise", "main", "doubtful", "block", "children")

    def __init__(self, tag: str, path: int, noise: bool, main: bool, doubtful: bool, block: Node | None):
        self.tag, self.path, self.noise, self.main = tag, path, noise, main
        self.doubtful, self.block = doubtful, block or self
        self.children: list[str] = []


class Block(NamedTuple):
    """A text with the path of its leaf and what the markup says about it."""

    text: str
    leaf: int
    noise: bool
    main: bool
    doubtful: bool


class Page:
    """The blocks of a page in order, its inner nodes, and the tree of its paths.

    ``nodes``: (path, layout hash). ``parents``: the path above each path; the root has 0.
    """

    def __init__(self, source: str, digest):
        self.digest = digest
        self.blocks: list[Block] = []
        self.nodes: list[tuple[int, int]] = []
        self.parents: dict[int, int] = {}
        self.has_main = False
        self.stack = [Node("", 0, False, False, False, None)]
        self.open: Counter[str] = Counter()
        self.text: list[str] = []
        self._read(source)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        match, unclosed = TOKEN.match, set()
        while at < size:
            token = match(source, at)
            at = token.end()
            tag = token["tag"]
            if tag is None:
                piece = token[0]
                if not piece.startswith(("<!", "<?")):
                    self.text.append(piece)
                continue
            tag = tag.lower()
            if token["close"]:
                self._close(tag)
                continue
            rest = token["rest"]
            if tag == "br":
                self.text.append(" ")
            if tag in VOID:
                if tag in BLOCKS:
                    self._flush()
                continue
            if tag in RAW and not rest.endswith("/>"):
                if tag in unclosed:
                    continue
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(source, at)
                if end is None and tag not in ("script", "style"):
                    unclosed.add(tag)
                    continue  # never closed: what follows is not all inside
                at = size if end is None else source.find(">", end.start()) + 1 or size
                continue
            self._open(tag, rest)
        self._flush()
        while len(self.stack) > 1:
            self._pop()

    def _open(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self._flush()
            if self.open["p"]:
                self._close_until({"p"}, {"article", "section", "div", "main", "td", "body"})
        if tag in CLOSES:
            self._close_until(*CLOSES[tag])
        if len(self.stack) > MOST_LEVELS:
            self._pop()
        parent = self.stack[-1]
        given = attributes(rest) if len(rest) > 1 else {}
        names = " ".join(value for name, value in given.items() if name in ("class", "id", "role"))
        label = f"{tag}.{names}" if names else tag
        within = parent.main or tag in ("article", "main")
        named = bool(names) and tag not in ("html", "body")
        suspect = named and NOISE_NAMES.search(names) is not None
        noise = (
            parent.noise
            or tag in NOISE_TAGS
            or tag == "header" and not parent.main
            or suspect and not within
            or named and within and tag not in HEADINGS and WITHIN.search(names) is not None
            or hidden(given)
        )
        # Comments and teasers are articles too, but not what the page is about.
        main = parent.main or tag in ("article", "main") and not noise
        doubtful = parent.doubtful or suspect and parent.main and tag in BLOCKS
        # Inline elements are not nodes of their own: their text belongs to the block around.
        block = None
        if tag in BLOCKS:
            above = parent.block
            above.children.append(label)
            path = self.digest(f"{above.path}>{label}")
            self.parents[path] = above.path
        else:
            path, block = parent.path, parent.block
            if noise and not parent.noise:
                self._flush()
        self.stack.append(Node(tag, path, noise, main, doubtful, block))
        self.open[tag] += 1

    def _pop(self) -> None:
        node = self.stack[-1]
        if node.tag in BLOCKS or node.noise and not self.stack[-2].noise:
            self._flush()
        self.stack.pop()
        self.open[node.tag] -= 1
        if node.tag in BLOCKS and node.children:
            self.nodes.append((node.path, self.digest(" ".join(dict.fromkeys(node.children)))))

    def _close(self, tag: str) -> None:
        if not self.open[tag]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            if tag not in BLOCKS and self.stack[depth].tag in BLOCKS:
                return  # an inline end tag does not close a block

    def _close_until(self, tags: set[str], bounds: set[str]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                while len(self.stack) > depth:
                    self._pop()
                return
            if self.stack[depth].tag in bounds:
                return

    def _flush(self) -> None:
        if not self.text:
            return
        text = " ".join(html.unescape("".join(self.text)).split())
        self.text = []
        if text:
            node = self.stack[-1]
            self.blocks.append(Block(text, node.path, node.noise, node.main, node.doubtful))
            self.has_main |= node.main and not node.noise

    def outside(self, block: Block) -> bool:
        """Whether a block is beside the article or main that its page has."""
        return self.has_main and not block.main

    def branches(self, leaf: int) -> list[int]:
        """Paths of the leaf and of what it is in, the root left out."""
        found = []
        while leaf in self.parents:
            found.append(leaf)
            leaf = self.parents[leaf]
        return found

    def main_text(self, low: frozenset[int], own: frozenset[int]) -> list[str]:
        """Blocks that remain, given the paths of branches that are not important, and of leaves that
        are important enough to remain outside article and main."""
        lost = {0: False}
        for path, above in self.parents.items():  # parents come first
            lost[path] = path in low or lost[above]
        return [
            b.text
            for b in self.blocks
            if not b.noise and not lost[b.leaf] and not (self.outside(b) and b.leaf not in own)
        ]


def _digest():
    import xxhash

    return lambda text: xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def style_rows(pages: DataFrame) -> DataFrame:
    """What the tree is made of: host, page digest, kind, path and feature.

    Kind 0: a text in a leaf. Kind 1: a layout of an inner node. Kind 2: that the page has the branch
    (feature 0), also as a leaf outside its article or main (1) or as a doubtful leaf within (2). Kind
    3: a leaf, as the feature, below the branch. Noise is left out, also for telling copies of a page.
    """

    def make():
        digest = _digest()

        def work(part):
            out = ([], [], [], [], [])
            for url, source in zip(
                part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True
            ):
                host = host_of(url)
                if host is None or not source:
                    continue
                page = Page(source, digest)
                blocks = [b for b in page.blocks if not b.noise]
                rows = {(0, b.leaf, digest(b.text)) for b in blocks}
                rows |= {(1, p, layout) for p, layout in page.nodes}
                rows |= {(2, b.leaf, 1) for b in blocks if page.outside(b)}
                rows |= {(2, b.leaf, 2) for b in blocks if b.doubtful}
                name = digest(repr([(b.text, b.leaf, page.outside(b)) for b in blocks]))
                for leaf in {b.leaf for b in blocks}:
                    above = page.branches(leaf)
                    rows |= {(2, p, 0) for p in above}
                    rows |= {(3, p, leaf) for p in above}
                for kind, path, feature in rows:
                    for column, value in zip(out, (host, name, kind, path, feature), strict=True):
                        column.append(value)
            return out

        return work

    ddl = "host string, page long, kind int, path long, feature long"
    return map_rows(pages.select("url", "html"), ddl, None, text="html", make=make)


def judged(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """host, path and low: branches that are less important than ``threshold``, and, with low false,
    leaves that are important enough to remain outside article and main."""
    # Copies of a page count once; partial aggregation merges what is frequent before the shuffle.
    counts = (
        style_rows(pages)
        .distinct()
        .groupBy("host", "kind", "path", "feature")
        .agg(F.count("*").alias("n"))
    )
    counts = written(counts, "style")
    # Sums over the texts of a leaf go to all branches above it; one row for each such branch and leaf.
    texts = counts.where("kind = 0").groupBy("host", "path")
    texts = texts.agg(F.sum(F.log("n")).alias("spread"), F.count("*").alias("texts"))
    below = counts.where("kind = 3").select("host", F.col("path").alias("branch"), F.col("feature").alias("path"))
    content = below.join(texts, ["host", "path"]).groupBy("host", "branch")
    content = content.agg(F.sum("spread").alias("spread"), F.sum("texts").alias("texts"))
    styles = (
        counts.where("kind IN (1, 2)")
        .groupBy("host", "path")
        .agg(
            F.max(F.expr("IF(kind = 2 AND feature = 0, n, NULL)")).alias("m"),
            F.sum(F.expr("IF(kind = 1, n, NULL)")).alias("layout_pages"),
            F.sum(F.expr("IF(kind = 1, n * ln(n), NULL)")).alias("n_ln_n"),
            F.max(F.expr("kind = 2 AND feature = 1")).alias("outside"),
            F.max(F.expr("kind = 2 AND feature = 2")).alias("doubtful"),
        )
        .withColumn("layouts", F.expr("ln(layout_pages) - n_ln_n / layout_pages"))
    )
    nodes = styles.join(content.withColumnRenamed("branch", "path"), ["host", "path"])
    content = "1 - spread / texts / ln(greatest(m, 2))"
    layout = "IF(layout_pages > 1, layouts / ln(layout_pages), 0)"
    importance = (
        f"CASE WHEN layouts IS NULL THEN {content}"
        f" ELSE {1 - GAMMA} * ({layout}) + {GAMMA} * ({content}) END"
    )
    low = f"{importance} < IF(doubtful, {OUTSIDE}, {threshold})"
    return nodes.where(
        f"m >= {LEAST_PAGES} AND ({low} OR outside AND {importance} >= {OUTSIDE})"
    ).selectExpr("host", "path", f"{low} AS low")


def extract(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars and n_blocks for every row.

    A null page is empty; one of which nothing remains has an empty text. A page whose url is null or
    has no host belongs to no tree, and all its branches are important. Rows with equal ids or equal
    pages get equal results; further columns change nothing. An empty table gives an empty result.
    """
    branches = written(judged(pages, threshold), "judged")
    # Branches of a host's template: as many as its pages have different paths.
    lists = branches.groupBy("host").agg(
        F.collect_set(F.expr("IF(low, path, NULL)")).alias("low"),
        F.collect_set(F.expr("IF(low, NULL, path)")).alias("own"),
    )
    lists = written(lists, "lists")  # so that a join with a large host's pages can be split
    host = F.lower(F.regexp_extract(F.trim("url"), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("page_host"))
    rows = rows.join(lists, rows.page_host == lists.host, "left").drop("host", "page_host")

    def make():
        digest = _digest()

        def work(part):
            texts, blocks = [], []
            columns = (part.column(c).to_pylist() for c in ("html", "low", "own"))
            for source, low, own in zip(*columns, strict=True):
                sets = frozenset(low or ()), frozenset(own or ())
                found = Page(source, digest).main_text(*sets) if source else []
                texts.append(" ".join(found))
                blocks.append(len(found))
            n_chars = [len(t) for t in texts]
            return part.column("page_id"), part.column("url"), pa.array(texts), n_chars, blocks

        return work

    ddl = "page_id long, url string, text string, n_chars long, n_blocks long"
    return map_rows(rows, ddl, None, text="html", make=make)
