"""Operator 6: main text of pages by site style trees.

The pages of a host are merged into one tree: a node is a path of elements (tag and class), and holds
how often each presentation (the tags of its children) and each content (its text) occurs. A node whose
pages agree tells little: its importance is the entropy of presentations and contents, 1 if every
page has its own and 0 if all have the same. Branches of low importance are cut from each page.

Two things are known beforehand and decide where statistics can't, as on a host with few pages: an
element that names its purpose (nav, footer, a class "ad") is cut, the article itself is not.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import map_texts, portions, settle, table

MIN_PAGES = 5
MIN_IMPORTANCE = 0.3
STYLE_WEIGHT = 0.1  # the rest is that of contents

# Element names and words of class, id and role by purpose.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title svg iframe object".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br img".split()
)
_NOISE_TAGS = frozenset("nav header footer aside form button select dialog menu head".split())
_MAIN_TAGS = frozenset("article main".split())
_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr"
    " notice alert popup modal overlay newsletter subscribe signup nav navbar navigation menu breadcrumb breadcrumbs"
    " pagination pager sidebar rail widget footer header masthead topbar toolbar share sharing social related"
    " recommended comments comment disqus respond replies login search skip copyright legal".split()
)
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main"
    " nav ol p pre section table ul".split()
)
_CLOSES_SAME = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}

_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th tr figcaption".split())
# In an article, and around one, these words stand for its own parts.
_SOFT_WORDS = frozenset("header masthead nav sidebar footer banner rail widget notice".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>])*+)>|</?[A-Za-z].*\Z|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([A-Za-z][-\w]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_DIGITS = re.compile(r"[0-9]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


class Node:
    """An element: its path in the tree, its state, the tags of its children, what its text hashes to."""

    __slots__ = ("tag", "path", "state", "inline", "above", "children", "content", "cut")

    def __init__(self, tag, path, state, inline, above):
        self.tag, self.path, self.state, self.inline, self.above = tag, path, state, inline, above
        self.children, self.content, self.cut = [], xxhash.xxh3_64(), False


def _state(tag: str, attributes: str, above: str) -> tuple[str, str]:
    """(name, state) of an element.

    `noise` holds for all below. `soft` noise is named by a word that may also stand on a frame around
    the article, so an article in it is one. `main` holds until something in it is noise.
    """
    name, words, role = tag, set(), ""
    if "=" in attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), next((v for v in values if v), "").lower()
            if key in ("class", "id"):
                words.update(re.findall(r"[a-z]+", value))
                name += (":" if key == "class" else "#") + re.sub(r"[\s/]+", "_", _DIGITS.sub("0", value))
            elif key == "role":
                role = value
    if above == "noise":
        return name, "noise"
    if tag in _MAIN_TAGS or role == "main":
        return name, "main"
    named = words & _NOISE_WORDS if tag not in ("body", "html") else set()
    if above == "main":
        tagged = tag in _NOISE_TAGS and tag != "header"
        return name, "noise" if tagged or named - {"header", "masthead"} else "main"
    if tag in _NOISE_TAGS or role in _NOISE_ROLES or named - _SOFT_WORDS:
        return name, "noise"
    return name, "soft" if named else above


def read(page: str) -> tuple[list[Node], list[tuple[Node, int, str]]]:
    """The elements of a page (the root first) and its texts as (element, block, text), in page order.

    Tag soup is read as it comes: what is not closed ends with its parent, a page that breaks off is
    read as far as it goes.
    """
    stack = [Node("", "", "open", False, None)]
    nodes, texts = [stack[0]], []
    block = at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[4] is not None:
            texts.append((stack[-1], block, m[4]))
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                block += any(not s.inline for s in stack[depth:])
                del stack[depth:]
            continue
        if tag in _RAW:
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _CLOSES_P:
            p = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            if p and all(s.inline for s in stack[p + 1:]):
                del stack[p:]
        elif tag in _CLOSES_SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _CLOSES_SAME[tag]:
                    break
                if stack[i].tag == tag:
                    del stack[i:]
                    break
        inline, top = tag in _INLINE, stack[-1]
        block += not inline
        name, state = _state(tag, m[3], top.state)
        top.children.append(tag)
        if tag == "br":
            texts.append((top, block, " "))
        if tag not in _VOID:
            nodes.append(Node(tag, f"{top.path}/{name}", state, inline, top))
            if not m[3].endswith("/"):
                stack.append(nodes[-1])
    return nodes, texts


def may_cut(node: Node) -> bool:
    """Whether statistics may cut an element: not the frame of the page, an article or its plain text."""
    if node.inline or node.tag in ("", "html", "body") or node.tag in _MAIN_TAGS:
        return False
    return node.state != "main" or not (node.tag in _TEXT_TAGS and node.path.endswith("/" + node.tag))


def main_text(page: str, cuts: frozenset) -> str:
    """The blocks of the page that are kept, one to a line: those of its articles if it has any."""
    nodes, texts = read(page)
    for node in nodes[1:]:
        node.cut = node.state != "main" and node.above.cut or node.state in ("noise", "soft") or (
            node.path in cuts and may_cut(node)
        ) or node.above.cut and node.above.state == "main"
    article = any(n.state == "main" for n in nodes)
    blocks: dict[int, list[str]] = {}
    for node, block, text in texts:
        if not node.cut and (node.state == "main" or not article):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def tree_rows(page: str) -> tuple[int, list[tuple[str, int, int, bool]]]:
    """A page's identity (hash of its main text) and its (path, presentation, content, may be cut)."""
    nodes, texts = read(page)
    for node, _, text in texts:
        node.content.update(" ".join(text.split()))
    found: dict[str, list] = {}
    for node in reversed(nodes[1:]):
        node.above.content.update(node.content.digest())
        if not node.inline:
            entry = found.setdefault(node.path, [xxhash.xxh3_64(), xxhash.xxh3_64(), may_cut(node)])
            entry[0].update(",".join(node.children))
            entry[1].update(node.content.digest())
    top = 1 << 63
    return (
        xxhash.xxh3_64_intdigest(main_text(page, frozenset())) - top,
        [(path, s.intdigest() - top, c.intdigest() - top, cut) for path, (s, c, cut) in found.items()],
    )


def _tree_scan():
    def one(raw):
        page, rows = tree_rows(raw.decode())
        return page, [dict(zip(("path", "style", "content", "may_cut"), r)) for r in rows]

    return lambda texts: [one(t) for t in texts]


TREE = "page bigint, nodes array<struct<path:string,style:bigint,content:bigint,may_cut:boolean>>"


def _host():
    return F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), _HOST, 1)).alias("host")


def style_trees(pages: DataFrame) -> DataFrame:
    """host, path, n_pages, may_cut, importance: the merged tree of each host, one row per node.

    Pages with the same main text count once, so copies of a page make no branch look alike. Counts are
    combined in map tasks before each shuffle; a host with a third of all pages arrives as one row per
    node, distinct content and task.
    """
    rows = map_texts(pages.select(_host(), "html"), _tree_scan, TREE, ("host",), "html")
    seen = rows.select("host", "page", F.explode("nodes").alias("n")).select("host", "page", "n.*").distinct()

    def entropy(of):
        counts = seen.groupBy("host", "path", of).agg(F.count("*").alias("k"))
        return counts.groupBy("host", "path").agg(
            F.sum("k").alias("n_pages"), F.sum(F.col("k") * F.log(F.col("k").cast("double"))).alias("s")
        ).select("host", "path", "n_pages", F.when(
            F.col("n_pages") > 1, 1 - F.col("s") / (F.col("n_pages") * F.log(F.col("n_pages").cast("double")))
        ).otherwise(1.0).alias(f"{of}_entropy"))

    seen = settle(seen)
    may = seen.groupBy("host", "path").agg(F.max("may_cut").alias("may_cut"))
    both = entropy("style").join(entropy("content").drop("n_pages"), ["host", "path"]).join(may, ["host", "path"])
    return both.withColumn(
        "importance", STYLE_WEIGHT * F.col("style_entropy") + (1 - STYLE_WEIGHT) * F.col("content_entropy")
    )


def low_branches(trees: DataFrame) -> DataFrame:
    """host, cuts: the paths of a host's nodes that tell too little. Their number is that of its templates."""
    low = (F.col("importance") < MIN_IMPORTANCE) & (F.col("n_pages") >= MIN_PAGES) & F.col("may_cut")
    return trees.where(low).groupBy(F.col("host").alias("cut_host")).agg(F.collect_set("path").alias("cuts"))


def _text_scan(batches):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    for batch in batches:
        for part in portions(batch, 2):
            ids, urls, raws, cuts = (part.column(i) for i in range(4))
            texts = [
                main_text(raw.decode(), frozenset(c or ())) for raw, c in zip(raws.to_pylist(), cuts.to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), urls.cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                schema=schema,
            )


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    A null or empty page has an empty text; a null url or one without a host belongs to the host "".
    Repeated rows each get theirs and count once in the tree. An empty table gives none; other columns
    are ignored. The pages meet their host's list of branches to cut, a table on disk.
    """
    cuts = settle(low_branches(style_trees(pages)))
    raw = F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("raw")
    rows = pages.select("page_id", "url", _host(), raw)
    joined = rows.join(cuts, rows["host"] == cuts["cut_host"], "left").select("page_id", "url", "raw", "cuts")
    return joined.mapInArrow(_text_scan, "page_id bigint, url string, text string, n_chars bigint")


def op6_html_text(spark, sf_dir) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


QUERIES = {"op6_html_text": op6_html_text}
SQL: dict[str, str] = {}
