"""Main text of web pages by a site style tree.

Every page is parsed into blocks of text, each with its style path: the
elements above it with their classes. The pages of a host are merged over
these paths. A node's presentation importance is the entropy, over the
host's distinct pages, of the child sequences it shows; a block's content
importance is one less the entropy of its text over the pages that hold it
(a text on one page only: 1; a text on all of them: 0). A block's importance
weighs both (``GAMMA``); branches below ``LEAST`` are removed. A text's
entropy is taken over the distinct articles that hold it, not the pages:
copies of an article on one host, under other menus, are one. A host of a
few pages says little, so ``PRIOR`` pages count as having other texts.

Every block that is text of the page goes through the tree; markup and names
are weights. Elements that are no text by their kind (``NOISE_TAGS``, roles,
hidden ones) and boxes that by all their names are something else
(``NOISE_NAMES``, beside words that say nothing, ``PLAIN``) have importance
0. Inside ``article`` and ``main`` a block falls short of full importance by
a share of what the tree takes off only (``INSIDE``): there a text goes if
nearly all articles of a host have it. Pages that have such an element keep
nothing outside it. A name of which only a part says noise ("ad-astra",
"comments-on-war", "social history") excludes nothing: it halves the
importance of its branch.

A box named as noise, or a form, may also be around the content. It counts
as what it says unless it holds an ``article`` or ``main`` and the page has
none outside elements of that kind: then its name says nothing. If it holds
most of a page's text and there is no other article, its text goes by the
tree like any other. Outer elements are judged before those they hold.

On Spark, paths and texts are counted as hashes with partial aggregation (a
host that holds a third of all pages is many keys of host, path and text).
The pages are parsed again for their texts, which is cheaper than storing
them, and joined with the decisions on their blocks.

Defined cases: null or empty html gives "" and 0; a null or broken url has
the host ""; pages of equal html count once in the tree; repeated rows are
kept; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campuslens.llm.workspace import Workspace

GAMMA = 0.9
LEAST = 0.35
PRIOR = 8
#: What the tree takes off a block outside, in ``main`` and in ``article``; what a partly telling name leaves.
INSIDE = (1.0, 0.85, 0.75)
WEAK_NAME = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
NOISE_TAGS = frozenset("""head script style noscript template iframe nav footer aside button select
textarea input menu dialog svg object video audio canvas title""".split())
NOISE_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
nav navbar navigation menu sidebar footer masthead breadcrumb breadcrumbs pagination pager toolbar
cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login share sharing
social related recommended comment comments disqus respond copyright disclaimer widget hidden""".split())
PLAIN = frozenset("""area bar block body bottom box btn button buttons card cards col component container count desktop
field fixed flex foot form full global grid group half head header holder icon icons inner item items left lg link links
list main md message messages mobile module outer page panel primary region replies reply right row secondary section
site slot sm small space sticky text thread title top unit wide wrap wrapper xs zone""".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section
summary table tbody td tfoot th thead tr ul caption""".split())
CLOSES_P = BLOCKS - frozenset("body html option optgroup".split())
# Open elements that a start tag ends, up to the nearest of the given bounds.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
P_BOUNDS = frozenset("button table td th object caption".split())

# A quote opens a value only right after the equals sign.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=/>][^\s=/>]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

DROP, DECIDE = 0, 1


class Block:
    """A text with its style path; depth 2 inside article, 1 inside main, else 0."""

    __slots__ = ("path", "parent", "noise", "depth", "text", "named", "weak", "state")

    def __init__(self, path, parent, noise, depth, text, named, weak):
        self.path, self.parent, self.noise, self.depth, self.text = path, parent, noise, depth, text
        self.weak = weak  # a name around it, inside article or main, says noise in part
        self.named = named  # numbers of the elements around it that a name or form makes noise


class Named:
    """An element that is noise by a name or as a form: what it holds, and whether it is spared."""

    __slots__ = ("level", "inside", "article", "main", "spared")

    def __init__(self, level, inside):
        self.level, self.inside, self.article, self.main, self.spared = level, inside, False, False, 0


def _says(names: str) -> int:
    """2 if class names and id all say noise (or nothing, but one of them noise), 1 if a part of them does."""
    noise = other = False
    for word in NAME.findall(names):
        word = word.lower()
        noise |= word in NOISE_NAMES
        other |= word not in NOISE_NAMES and word not in PLAIN
    return 0 if not noise else 1 if other else 2


def _marks(tag: str, attrs: str):
    """(style label, is noise, what its names say or 2 for a form) of a start tag."""
    if not attrs.strip():
        return tag, tag in NOISE_TAGS, 2 * (tag == "form")
    found: dict = {}
    for k, v in ATTR.findall(attrs):
        found.setdefault(k.lower(), v[1:-1] if v[:1] in "\"'" and len(v) > 1 and v[-1] == v[0] else v)
    noise = (tag in NOISE_TAGS or found.get("role", "").lower() in NOISE_ROLES or "hidden" in found
             or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower())
    named = 0
    if tag == "form" or found.get("role", "").lower() == "form":
        named = 2
    elif tag not in ("html", "body", "article", "main"):
        named = _says(f"{found.get('class', '')} {found.get('id', '')}")
    return f"{tag}.{found.get('class', '')}", noise, named


SPARED, WEIGHED = 1, 2


def _decide(blocks: list[Block], named: list[Named]) -> None:
    """States of a page's blocks."""
    size = sum(len(b.text) for b in blocks if not b.noise)
    for level in sorted({e.level for e in named}):
        free = max((b.depth for b in blocks if not b.noise and all(named[i].spared == SPARED for i in b.named)), default=0)
        for e in named:
            if e.level == level and ((e.article and not e.inside and free < 2) or (e.main and free < 1)):
                e.spared = SPARED
    free = max((b.depth for b in blocks if not b.noise and all(named[i].spared == SPARED for i in b.named)), default=0)
    if free < 2:
        for i, e in enumerate(named):
            if not e.spared and 2 * sum(len(b.text) for b in blocks if not b.noise and i in b.named) > size:
                e.spared = WEIGHED
    live = [not b.noise and all(named[i].spared for i in b.named) for b in blocks]
    weighed = [any(named[i].spared == WEIGHED for i in b.named) for b in blocks]
    marked = any(x and (b.depth == 2 or (b.depth and not w)) for b, x, w in zip(blocks, live, weighed))
    for b, x, w in zip(blocks, live, weighed):
        if not x or (marked and not b.depth):
            b.state = DROP
        else:
            b.state = DECIDE


def parse(page: str) -> tuple[list[Block], dict[str, str]]:
    """Blocks in page order, and the child sequence of every path."""
    stack: list = []  # (tag, path, noise, inside article, inside main, numbers of named elements, weak name)
    named: list[Named] = []
    children: dict = {}
    blocks: list[Block] = []
    text: list = []  # (piece, numbers of the named elements it is in)

    def add(piece):
        text.append((piece, stack[-1][5] if stack else ()))

    def flush():
        if text:
            groups: dict = {}
            for piece, within in text:
                groups.setdefault(within, []).append(piece)
            text.clear()
            own = next((e for e in reversed(stack) if e[0] in BLOCKS), ("", "", False, False, False, (), False))
            up = own[1].rpartition(">")[0]
            noise, article, main = (stack[-1][2:5] if stack else (False, False, False))
            weak = bool(stack) and stack[-1][6]
            for within, pieces in groups.items():
                joined = " ".join("".join(pieces).split())
                if joined:
                    blocks.append(Block(own[1], up, noise, 2 if article else 1 if main else 0, joined, within, weak))

    def close(upto):
        if any(e[0] in BLOCKS for e in stack[upto:]):
            flush()
        del stack[upto:]

    def end_open(tags, bounds):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                close(i)
                return
            if stack[i][0] in bounds:
                return

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            if not (stack and stack[-1][2]):
                add(html_lib.unescape(page[at:]))
            break
        if m.start() > at and not (stack and stack[-1][2]):
            add(html_lib.unescape(page[at:m.start()]))
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag == "br":
                add(" ")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in ("article", "main", "body", "table") and tag not in ("html", "body", "article", "main"):
                    break
            continue
        if tag == "br" or tag == "wbr":
            add(" " if tag == "br" else "")
            continue
        if tag in BLOCKS:
            flush()
        if tag in CLOSES_P:
            end_open({"p"}, P_BOUNDS)
        if tag in ENDS:
            end_open(*ENDS[tag])
        label, noise, by_name = _marks(tag, m["attrs"])
        up = stack[-1] if stack else ("", "", False, False, False, (), False)
        children[up[1]] = children.get(up[1], "") + label + " "
        if tag in VOID:
            continue
        if tag in RAW:
            done = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = done.end() if done else size
            continue
        if tag == "header" and not (up[3] or up[4]):
            noise = True
        within = up[5]
        if not (up[2] or noise):
            if tag in ("article", "main"):
                for i in within:
                    named[i].article |= tag == "article"
                    named[i].main |= tag == "main"
            if by_name == 2:
                named.append(Named(len(within), up[3]))
                within += (len(named) - 1,)
        stack.append((tag, f"{up[1]}>{label}", up[2] or noise, (up[3] or tag == "article"), (up[4] or tag == "main"), within,
                      tag not in ("article", "main") and (up[6] or by_name == 1)))
    flush()
    _decide(blocks, named)
    return blocks, children


def _long(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def host_of(url) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


_BLOCK = "array<struct<path:bigint,parent:bigint,feature:bigint,page:bigint,scale:double,offset:double>>"
_HASHES = f"host string, content long, blocks {_BLOCK}, nodes array<struct<path:bigint,style:bigint>>"
_TEXTS = "page_id long, url string, host string, content long, texts array<string>"


_ARROW = {
    _HASHES: pa.schema([("host", pa.string()), ("content", pa.int64()),
                        ("blocks", pa.list_(pa.struct([*[(c, pa.int64()) for c in ("path", "parent", "feature", "page")],
                                                       ("scale", pa.float64()), ("offset", pa.float64())]))),
                        ("nodes", pa.list_(pa.struct([("path", pa.int64()), ("style", pa.int64())])))]),
    _TEXTS: pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("content", pa.int64()),
                       ("texts", pa.list_(pa.string()))])}


def _parsed(pages: DataFrame, make, schema: str) -> DataFrame:
    """One row per page: ``make(page_id, url, host, content, blocks, children)``."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [make(i, url, host_of(url), _long(page or ""), *parse(page or ""))
                        for i, url, page in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW[schema])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html")).mapInArrow(run, schema))


def weights(block: Block) -> tuple[float, float]:
    """(scale, offset): a block's importance is scale x what the tree says + offset."""
    taken, name = INSIDE[block.depth], WEAK_NAME if block.weak else 1.0
    return name * taken, name * (1 - taken)


def _live(blocks: list[Block]) -> list[Block]:
    return [b for b in blocks if b.state != DROP]


def _hashed_page(content: int, blocks: list[Block], children: dict) -> dict:
    live = _live(blocks)
    # blocks of an article belong to it, whatever page it is on
    article = _long("\n".join(b.text for b in live if b.depth == 2))
    rows = []
    for b in live:
        scale, offset = weights(b)
        rows.append({"path": _long(b.path), "parent": _long(b.parent), "feature": _long(b.text),
                     "page": article if b.depth == 2 else content, "scale": scale, "offset": offset})
    return {"blocks": rows, "nodes": [{"path": _long(p), "style": _long(s)} for p, s in children.items()]}


def hashed(pages: DataFrame) -> DataFrame:
    """What the tree is built from: hosts, the blocks that are text, and nodes, as hashes."""
    return _parsed(pages, lambda i, url, host, content, blocks, children: {
        "host": host, "content": content, **_hashed_page(content, blocks, children)}, _HASHES)


def texts(pages: DataFrame) -> DataFrame:
    """The texts of the same blocks."""
    return _parsed(pages, lambda i, url, host, content, blocks, children: {
        "page_id": i, "url": url, "host": host, "content": content, "texts": [b.text for b in _live(blocks)]}, _TEXTS)


def importances(rows: DataFrame) -> DataFrame:
    """(host, path, parent, feature, importance) of every kind of block: what the tree says of it.

    Entropies are to the base of the host's distinct pages (articles, where
    the block is in one) that have the path.
    """
    seen = (rows.select("host", F.explode("blocks").alias("b"))
            .select("host", "b.path", "b.parent", "b.feature", "b.page").distinct())
    per_text = seen.groupBy("host", "path", "parent", "feature").agg(F.count(F.lit(1)).alias("n"))
    per_path = (seen.select("host", "path", "page").distinct()
                .groupBy("host", "path").agg(F.count(F.lit(1)).alias("m")))
    styles = (rows.select("host", "content", F.explode("nodes").alias("s"))
              .select("host", "content", F.col("s.path").alias("parent"), "s.style").distinct()
              .groupBy("host", "parent", "style").agg(F.count(F.lit(1)).alias("k")))
    # -sum(p log p) with p = k / m is log m - sum(k log k) / m
    node = (styles.groupBy("host", "parent")
            .agg(F.sum("k").alias("pages"), F.sum(F.col("k") * F.log("k")).alias("klogk"))
            .select("host", "parent", F.when(F.col("pages") <= 1, F.lit(1.0)).otherwise(
                1 - F.col("klogk") / F.col("pages") / F.log("pages")).alias("shape")))
    text = 1 - F.log("n") / F.log(F.col("m") + PRIOR)
    weighed = F.lit(1 - GAMMA) * F.coalesce("shape", F.lit(1.0)) + F.lit(GAMMA) * text
    return (per_text.join(per_path, ["host", "path"]).join(node, ["host", "parent"], "left")
            .select("host", "path", "parent", "feature", weighed.alias("importance")))


def main_text(pages: DataFrame, least: float = LEAST) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    work = Workspace(pages.sparkSession, "site-tree")
    tree = work.stage(hashed(pages), "tree")
    blocks = (tree.select("host", "content", F.posexplode("blocks").alias("pos", "b"))
              .select("host", "content", "pos", "b.path", "b.parent", "b.feature", "b.scale", "b.offset").distinct())
    gone = (blocks.join(importances(tree), ["host", "path", "parent", "feature"])
            .where(F.col("scale") * F.col("importance") + F.col("offset") < least)
            .groupBy("host", "content").agg(F.collect_set("pos").alias("gone")))  # positions of one page's blocks
    kept = F.filter("texts", lambda t, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    out = (texts(pages).join(work.stage(gone, "gone"), ["host", "content"], "left")
           .select("page_id", "url", F.array_join(kept, "\n").alias("text"))
           .withColumn("n_chars", F.length("text").cast("long")))
    return work.result(out)
