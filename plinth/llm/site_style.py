"""Main text of web pages by site style trees.

All pages of a host are merged into one tree. An element node is a place: the host, and from the root down each chosen
child sequence and the position in it. A style node is one sequence of children (tags with their class and id) that
pages have at such a place. For an element that m pages share,

    presentation importance  = the entropy, to base m, of which style its pages choose;
    content importance       = 1 - the mean entropy, to base m, of its texts over the pages that hold them, less one
                               (a single copy is no pattern); each text weighs as much as it has pages;
    composite importance     = (1 - GAMMA ** l) * presentation + GAMMA ** l * mean of its styles' importance, weighted
                               by their pages, where a style's is the mean of its children's and l the number of styles.

Navigation, advertisements and footers come again and again in the same place with the same texts and score near 0;
articles differ and score near 1. A branch all of whose elements score below ``THRESHOLD`` is removed from each page.

The trees are never built as objects: places are hashes, pages are mapped to (place, style) and (place, text) counts
that Spark adds up, and importance moves up the tree one depth at a time: in one task where the places that a site shares
are ``SITE_PLACES`` or fewer, however deep they lie, else in a join for each depth. Places of fewer than ``MIN_PAGES``
pages say nothing and count as important, so the tables hold only what pages share.

Of the branches to remove only the topmost places are kept. They go to the pages as a list, or, where a site has more than
``SITE_NOISE`` of them, by a join of its pages' places, which gives each page those that it has.
"""

from __future__ import annotations

import html as html_
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.components import cut, discard

GAMMA = 0.9
THRESHOLD = 0.8
MIN_PAGES = 4
SITE_PLACES = 100_000
SITE_NOISE = 2_000
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "noscript", "template")}
_SKIP = frozenset("script style noscript template head svg iframe object".split())
_INLINE = frozenset("a abbr b bdi bdo cite code em font i kbd label mark q s samp small span strong sub sup time tt u var".split())
#: An opening tag of the first kind ends an open element of the second.
_CLOSES = {t: frozenset(o) for t, o in {"p": ["p"], "li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "tr": ["tr", "td", "th"], "td": ["td", "th"], "th": ["td", "th"], "option": ["option"]}.items()} | {t: frozenset(["p"]) for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()}
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


class Node:
    __slots__ = ("children", "features", "place", "sign", "tag", "text")

    def __init__(self, tag: str, sign: str) -> None:
        self.tag, self.sign, self.text = tag, sign, ""
        self.children: list[Node] = []
        self.features: list[str] = []
        self.place = 0


def parse(page: str) -> Node:
    """A lenient tree of elements; text becomes '#' children, what isn't shown is left out."""
    root = Node("", "")
    stack, at, text_at = [root], 0, 0
    opened: dict[str, int] = {}

    def close(k: int) -> None:
        for node in stack[k:]:
            opened[node.tag] -= 1
        del stack[k:]

    while True:
        m = _TOKEN.search(page, at)
        _add_text(stack[-1], page[text_at : m.start() if m else len(page)])
        if not m:
            return root
        at = text_at = m.end()
        if m[1]:
            _add_text(stack[-1], m[1])
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:
            # Whatever isn't open is passed over without a look at what is.
            for k in range(len(stack) - 1, 0, -1) if opened.get(tag) else ():
                if stack[k].tag == tag:
                    close(k)
                    break
            continue
        if tag in _RAW:
            end = _RAW[tag].search(page, at)
            at = text_at = end.end() if end else len(page)
            continue
        closes = _CLOSES.get(tag)
        if closes and any(opened.get(o) for o in closes):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    close(k)
                    break
                if stack[k].tag not in _INLINE and stack[k].tag != "p":
                    break
        attributes = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(m[4])}
        node = Node(tag, f"{tag}.{attributes.get('class', '')}#{attributes.get('id', '')}")
        for name in ("href", "src"):
            if attributes.get(name):
                node.features.append(f"{name}={attributes[name]}")
        if tag == "head":
            end = re.compile(r"</head\s*>|<body\b", re.I).search(page, at)
            at = text_at = (end.end() if end and end[0][1] == "/" else end.start() if end else at)
            continue
        stack[-1].children.append(node)
        if tag not in _VOID and not m[4].endswith("/"):
            stack.append(node)
            opened[tag] = opened.get(tag, 0) + 1


def _add_text(parent: Node, raw: str) -> None:
    text = " ".join(html_.unescape(raw).split())
    if text and parent.tag not in _SKIP:
        node = Node("#", "#")
        node.text = text
        node.features = [s for s in (x.strip() for x in _SENTENCE.findall(text)) if s]
        parent.children.append(node)


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"))


def place_nodes(root: Node, site: int) -> Iterator[tuple[Node, int, int]]:
    """Gives each element its place; yields (element, its style or 0, depth)."""
    root.place = _hash(site)
    stack = [(root, 0)]
    while stack:
        node, depth = stack.pop()
        style = 0
        if node.children:
            style = _hash(node.place, *(c.sign for c in node.children))
            for k, child in enumerate(node.children):
                child.place = _hash(style, k)
                stack.append((child, depth + 1))
        yield node, style, depth


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pages have the style (kind 0) or text (1) ``item`` at the place, or the place itself (2) within the style ``item``."""
    for batch in batches:
        found: dict[tuple, int] = {}
        for site, page in zip(batch.column("site").to_pylist(), batch.column("html").to_pylist(), strict=True):
            for node, style, depth in place_nodes(parse(page or ""), site):
                keys = [(site, node.place, _hash(feature), 1, depth, 0) for feature in set(node.features)]
                if style:
                    keys.append((site, node.place, style, 0, depth, 0))
                    keys += [(site, child.place, style, 2, depth + 1, node.place) for child in node.children]
                for key in keys:
                    found[key] = found.get(key, 0) + 1
        if found:
            site, place, item, kind, depth, parent = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(site, pa.int64()), pa.array(_signed(list(place))), pa.array(_signed(list(item))), pa.array(kind, pa.int32()), pa.array(depth, pa.int32()), pa.array(_signed(list(parent))), pa.array(list(found.values()), pa.int64())],
                names=["site", "place", "item", "kind", "depth", "parent", "n"],
            )


def style_tree(pages: DataFrame, gamma: float = GAMMA, min_pages: int = MIN_PAGES, site_places: int = SITE_PLACES) -> DataFrame:
    """(site, place, above, parent, importance, most): composite importance of the places that ``min_pages`` pages share, and the most in its branch. pages: (site, html).

    A table in the shared folder; above and parent are the style and the element that a place lies in, 0 for roots.
    """
    counts = cut(pages.mapInArrow(_count, "site long, place long, item long, kind int, depth int, parent long, n long").groupBy("site", "place", "item", "kind", "depth", "parent").agg(F.sum("n").alias("n")).where(f"n >= {min_pages} or kind < 2"), "places")
    # A place's pages: those of its parent's style. Kind 2 rows are (place, style above it); each place has just one.
    shared = counts.where("kind = 2").select("site", "place", F.col("item").alias("above"), "parent", "depth", F.col("n").alias("m"))
    roots = counts.where("kind = 0 and depth = 0").groupBy("site", "place").agg(F.sum("n").alias("m")).where(f"m >= {min_pages}").select("site", "place", F.lit(0).cast("long").alias("above"), F.lit(0).cast("long").alias("parent"), F.lit(0).alias("depth"), "m")
    shared = shared.unionByName(roots)
    log = F.log(F.col("m").cast("double"))
    p = F.col("n") / F.col("m")
    chosen = shared.join(counts.where("kind = 0").select("place", F.col("item").alias("style"), "n"), "place")
    shape = chosen.groupBy("place").agg(F.sum(-p * F.log(p) / log).alias("presentation"), F.count("*").alias("styles"), (F.lit(1.0) - F.sum(F.when(F.col("n") >= min_pages, p).otherwise(0.0))).alias("rare"))
    texts = shared.join(counts.where("kind = 1").select("place", "n"), "place").groupBy("place").agg((1 - F.sum(F.col("n") * F.log(F.greatest(F.least("n", "m") - 1, F.lit(1)).cast("double")) / log) / F.sum("n")).alias("content"))
    nodes = cut(shared.join(shape, "place", "left").join(texts, "place", "left"), "nodes")
    sizes = cut(nodes.groupBy("site").agg(F.count("*").alias("n")), "sizes")
    large = sizes.where(F.col("n") > site_places).select("site")
    result = "site long, place long, above long, parent long, importance double, most double"
    if large.head(1):
        by_task = nodes.join(large, "site", "left_anti").groupBy("site").applyInArrow(lambda table: _importance(table, gamma), result)
        levels = _by_depth(nodes.join(large, "site", "left_semi"), gamma)
        out = by_task.unionByName(levels[0].select(*by_task.columns))
        for other in levels[1:]:
            out = out.unionByName(other.select(*by_task.columns))
    else:
        levels = []
        out = nodes.groupBy("site").applyInArrow(lambda table: _importance(table, gamma), result)
    tree = cut(out, "tree")
    discard(counts, nodes, sizes, *levels)
    return tree


def _composite(gamma: float, presentation: np.ndarray, styles: np.ndarray, rare: np.ndarray, content: np.ndarray, inner: np.ndarray, inner_most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(importance, most) of places; NaN stands for what a place hasn't got: no children (styles) or no texts (content). inner: what its children add."""
    leaf, mute = np.isnan(styles), np.isnan(content)
    within = np.where(leaf, content, np.where(np.isnan(inner), rare, inner))
    weight = gamma ** np.nan_to_num(styles)
    own = np.clip((1 - weight) * np.nan_to_num(presentation) + weight * np.nan_to_num(within), 0.0, 1.0)
    own = np.where(leaf & mute, 0.0, own)
    own = np.where(~leaf & ~mute, np.fmax(own, content), own)
    return own, np.maximum(np.maximum(own, np.nan_to_num(inner_most)), np.where(np.nan_to_num(rare) > 1e-9, 1.0, 0.0))


def _importance(table: pa.Table, gamma: float) -> pa.Table:
    """The importance of one site's places, from the deepest up; same as ``_by_depth``."""

    def column(name: str) -> np.ndarray:
        c = table.column(name).combine_chunks()
        return c.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) if name not in ("place", "above", "parent") else c.to_numpy()

    place, above, parent = column("place"), column("above"), column("parent")
    depth, m, presentation, styles, rare, content = (column(k) for k in ("depth", "m", "presentation", "styles", "rare", "content"))
    n = len(place)
    order = np.argsort(place, kind="stable")
    slot = np.minimum(np.searchsorted(place[order], parent), n - 1)
    up = np.where(place[order][slot] == parent, order[slot], -1)
    importance, most, total, inner_most = np.zeros(n), np.zeros(n), np.full(n, np.nan), np.full(n, np.nan)
    for level in range(int(depth.max()), -1, -1):
        here = np.flatnonzero(depth == level)
        inner = total[here] / m[here] + np.nan_to_num(rare[here])
        importance[here], most[here] = _composite(gamma, presentation[here], styles[here], rare[here], content[here], inner, inner_most[here])
        # A style's importance is the mean of its children's; each style weighs as many pages as it has.
        mine = here[np.lexsort((above[here], parent[here]))]
        if not len(mine) or level == 0:
            continue
        heads = np.flatnonzero(np.concatenate([[True], (parent[mine][1:] != parent[mine][:-1]) | (above[mine][1:] != above[mine][:-1])]))
        size = np.diff(np.concatenate([heads, [len(mine)]]))
        share = np.add.reduceat(importance[mine], heads) / size * m[mine[heads]]
        highest = np.maximum.reduceat(most[mine], heads)
        above_it = up[mine[heads]]
        some = above_it >= 0
        total[above_it[some]] = np.nan_to_num(total[above_it[some]])
        np.add.at(total, above_it[some], share[some])
        inner_most[above_it[some]] = np.nan_to_num(inner_most[above_it[some]])
        np.maximum.at(inner_most, above_it[some], highest[some])
    names = ["site", "place", "above", "parent"]
    return pa.table({**{k: table.column(k) for k in names}, "importance": pa.array(importance), "most": pa.array(most)})


def _by_depth(nodes: DataFrame, gamma: float) -> list[DataFrame]:
    """Tables of (site, place, above, parent, m, importance, most), one for each depth, the deepest first; for sites of any size."""
    deepest = nodes.agg(F.max("depth")).first()[0]
    done: list[DataFrame] = []
    below: DataFrame | None = None
    for depth in range(deepest if deepest is not None else 0, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        if below is None:
            level = level.withColumn("inner", F.lit(None).cast("double")).withColumn("inner_most", F.lit(None).cast("double"))
        else:
            style = below.groupBy("parent", "above").agg(F.avg("importance").alias("i"), F.max("most").alias("x"), F.first("m").alias("n"))
            inner = style.groupBy(F.col("parent").alias("place")).agg(F.sum(F.col("i") * F.col("n")).alias("sum"), F.max("x").alias("inner_most"))
            level = level.join(inner, "place", "left").withColumn("inner", F.col("sum") / F.col("m") + F.coalesce("rare", F.lit(0.0))).drop("sum")
        # Styles of too few pages count as important.
        level = level.withColumn("inner", F.when(F.col("styles").isNull(), F.col("content")).otherwise(F.coalesce("inner", F.col("rare"))))
        weight = F.pow(F.lit(gamma), F.coalesce("styles", F.lit(0)).cast("double"))
        own = (1 - weight) * F.coalesce("presentation", F.lit(0.0)) + weight * F.coalesce("inner", F.lit(0.0))
        own = F.when(F.col("styles").isNull() & F.col("content").isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), own)))
        level = level.withColumn("importance", F.when(F.col("styles").isNotNull() & F.col("content").isNotNull(), F.greatest(own, "content")).otherwise(own))
        rare = F.when(F.coalesce("rare", F.lit(0.0)) > 1e-9, 1.0).otherwise(0.0)
        level = level.withColumn("most", F.greatest("importance", F.coalesce("inner_most", F.lit(0.0)), rare))
        below = cut(level.select("site", "place", "above", "parent", "m", "importance", "most"), "level")
        done.append(below)
    return done


def page_text(root: Node, noise: frozenset[int] | set[int]) -> tuple[str, int]:
    """(text, removed branches) of a parsed page whose places are set; block elements begin a new line."""
    lines: list[list[str]] = [[]]
    removed = 0
    stack: list[Node | None] = [root]
    while stack:
        node = stack.pop()
        if node is None:
            lines.append([])
            continue
        if node.place in noise:
            removed += 1
            continue
        if node.tag == "#":
            lines[-1].append(node.text)
            continue
        block = node.tag not in _INLINE
        if block:
            lines.append([])
            stack.append(None)
        stack.extend(reversed(node.children))
    return "\n".join(" ".join(x) for x in lines if x), removed


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for page_id, host, site, page, noise in zip(*(batch.column(k).to_pylist() for k in ("page_id", "host", "site", "html", "noise")), strict=True):
            root = parse(page or "")
            for _ in place_nodes(root, site):
                pass
            text, removed = page_text(root, {x & 0xFFFFFFFFFFFFFFFF for x in noise or ()})
            restored = 0
            if removed and not text:
                # All of its content is in places that others share: a copy as a whole.
                text, removed, restored = page_text(root, frozenset())[0], 0, removed
            rows.append((page_id, host, text, removed, restored))
        if rows:
            page_id, host, text, removed, restored = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(page_id, pa.int64()), pa.array(host, pa.string()), pa.array(text, pa.string()), pa.array(removed, pa.int32()), pa.array(restored, pa.int32())], names=["page_id", "host", "text", "removed", "restored"])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(site, page, place) of every element of a page; page is the hash of its html."""
    for batch in batches:
        found = [(site, key, node.place) for site, key, page in zip(*(batch.column(k).to_pylist() for k in ("site", "page", "html")), strict=True) for node, _, _ in place_nodes(parse(page or ""), site)]
        if found:
            site, key, place = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(site, pa.int64()), pa.array(key, pa.int64()), pa.array(_signed(list(place)))], names=["site", "page", "place"])


def site_text(
    pages: DataFrame, threshold: float = THRESHOLD, gamma: float = GAMMA, min_pages: int = MIN_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", site_places: int = SITE_PLACES, site_noise: int = SITE_NOISE
) -> DataFrame:
    """(page_id, host, text, removed, restored): each page's text without the branches that its site repeats, and how many went.

    The host is the lower-cased authority of the url; null or relative urls share the host ''. Null or empty html gives
    an empty text; pages may be nested to any depth. A page of which no text would be left, as all of it is in branches
    that other pages share, is a copy as a whole and keeps everything: removed is 0 then and ``restored`` says how many
    branches had gone. Any other page keeps what is its own, however little. Hosts of fewer than ``min_pages`` pages have
    nothing removed. Repeated rows count as pages of their own; an empty table gives an empty result; other columns are
    ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce(pages[url_col].cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), host.alias("host"), F.xxhash64(host).alias("site"), pages[html_col].cast("string").alias("html"))
    tree = style_tree(rows.select("site", "html"), gamma, min_pages, site_places)
    low = tree.where(F.col("most") < threshold).select("site", "place", "parent")
    top = cut(low.join(low.select("site", F.col("place").alias("parent")), ["site", "parent"], "left_anti").select("site", "place"), "top")
    large = cut(top.groupBy("site").agg(F.count("*").alias("n")).where(F.col("n") > site_noise).select("site"), "large")
    shape = "page_id long, host string, text string, removed int, restored int"
    some = bool(large.head(1))
    small = top.join(large, "site", "left_anti") if some else top
    noise = cut(small.groupBy("site").agg(F.collect_set("place").alias("noise")), "noise")
    discard(tree)
    if not some:
        discard(top, large)
        return rows.join(noise, "site", "left").mapInArrow(_extract, shape)
    calm = rows.join(large, "site", "left_anti").join(noise, "site", "left").mapInArrow(_extract, shape)
    busy = rows.join(large, "site", "left_semi").withColumn("page", F.xxhash64(F.coalesce("html", F.lit(""))))
    held = busy.select("site", "page", "html").dropDuplicates(["site", "page"]).mapInArrow(_places, "site long, page long, place long")
    own = held.join(top, ["site", "place"], "left_semi").groupBy("site", "page").agg(F.collect_set("place").alias("noise"))
    return calm.unionByName(busy.join(own, ["site", "page"], "left").mapInArrow(_extract, shape))
