"""Main text of web pages by wrapper induction: same-host pages are aligned by simple tree matching."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclake.llm.bpe import batches
from topiclake.llm.common import SMALL_ROWS, cut, small

#: Pages of one host that are aligned together, about; a host of more pages is dealt to several groups, whose votes add up.
GROUP_PAGES = 32
#: A node's text belongs to the template if so many different pages were aligned with it and so large a share had that text.
LEAST_PAGES, CONSTANT_SHARE = 3, 0.5

# Element names and their roles in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
    "td": frozenset("td th tr tbody tfoot".split()), "th": frozenset("td th tr tbody tfoot".split()), "tr": frozenset("tr tbody tfoot".split()),
}
DROPPED = RAW | frozenset("head title template object embed applet svg math canvas audio video map nav footer aside form button select textarea dialog menu input".split())
MAIN = frozenset(["article", "main"])
# Words of class names, ids and roles that mark what surrounds an article.
SURROUNDINGS = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar nav navbar navigation menu
    breadcrumb breadcrumbs masthead header footer contentinfo complementary comment comments commentlist disqus respond reply replies cookie
    cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social related
    recommended widget widgets pagination pager toolbar skip""".split()
)

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
_NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLASS = re.compile(r"""class\s*=\s*["']?\s*([\w-]+)""", re.I)
_SPLIT = re.compile(r"[\s_-]+")


class Node:
    __slots__ = ("label", "tag", "children", "text", "names")

    def __init__(self, tag: str, label: str, names: frozenset[str] = frozenset(), text: str = ""):
        self.tag, self.label, self.names, self.text = tag, label, names, text
        self.children: list[Node] = []


def parse(page: str) -> Node:
    """A page's tree; tags that are left open, closed twice or never opened do no harm."""
    root = Node("#root", "#root")
    stack, at, size = [root], 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if piece[:2] in ("<!", "<?"):
                if not piece.startswith("<![CDATA["):
                    continue
                piece = piece[9:].removesuffix("]]>")
            stack[-1].children.append(Node("#text", "#text", text=piece))
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        for i in range(len(stack) - 1, 0, -1):
            open_tag = stack[i].tag
            if tag in CLOSES.get(open_tag, ()):
                del stack[i:]
                break
            if open_tag not in INLINE and open_tag not in CLOSES:
                break
        attributes = m[3]
        names: frozenset[str] = frozenset()
        label = tag
        if "=" in attributes:
            names = frozenset(w for g in _NAMED.findall(attributes) for v in g if v for w in _SPLIT.split(v.lower()))
            if c := _CLASS.search(attributes):
                label = f"{tag}.{c[1]}"
        node = Node(tag, label, names)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}", re.I).search(page, at)
            at = end.start() if end else size
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
    return root


def _has_main(node: Node, found: dict[int, bool]) -> bool:
    """Whether a page's article lies below each node."""
    stack = [(node, False)]
    while stack:
        x, done = stack.pop()
        if done:
            found[id(x)] = (x.tag in MAIN and "comment" not in x.names) or any(found[id(c)] for c in x.children)
        else:
            stack.append((x, True))
            stack += [(c, False) for c in x.children]
    return found[id(node)]


def _text_key(path: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{path}\n{text}") - 2**63


def blocks(root: Node) -> list[tuple[str, list[int], bool]]:
    """Text blocks in page order: text, keys of its text nodes as in ``skeleton``, whether it lies in an article.

    What names itself menu, header, footer, sidebar, notice, advert, form, script, style or comments is left out. Where the
    page marks an article, only that counts.
    """
    found: dict[int, bool] = {}
    marked = _has_main(root, found)
    out: list[tuple[str, list[int], bool]] = []
    held: list[str] = []
    keys: list[int] = []

    def flush(main: bool) -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        if text and (main or not marked):
            out.append((text, keys[:], main))
        held.clear()
        keys.clear()

    stack: list[tuple] = [(root, "", False, False)]
    while stack:
        node, path, main, leaving = stack.pop()
        if leaving:
            flush(main)
            continue
        if node.tag == "#text":
            held.append(node.text)
            if text := " ".join(entities.unescape(node.text).split()):
                keys.append(_text_key(path, text))
            continue
        here = main or (node.tag in MAIN and "comment" not in node.names)
        inner = f"{path}>{node.label}"
        if node.tag not in INLINE:
            flush(main)
            stack.append((node, inner, here, True))
        elif node.tag in ("br", "wbr", "img"):
            held.append(" " if node.tag == "br" else "")
        if not found[id(node)]:
            dropped = node.tag in DROPPED or (node.tag == "header" and not main)
            if dropped or (not node.names.isdisjoint(SURROUNDINGS) and node.tag not in ("body", "html")):
                continue
        stack += [(c, inner if node.tag not in INLINE else path, here, False) for c in reversed(node.children)]
    flush(False)
    return out


def skeleton(root: Node) -> str:
    """A tree in lines of depth, label and hash of text: all that the alignment needs."""
    lines: list[str] = []
    stack = [(root, 0, "")]
    while stack:
        node, depth, path = stack.pop()
        if node.tag == "#text":
            if text := " ".join(entities.unescape(node.text).split()):
                lines.append(f"{depth} #text {_text_key(path, text)}")
            continue
        lines.append(f"{depth} {node.label} 0")
        inner = path if node.tag in INLINE else f"{path}>{node.label}"
        stack += [(c, depth + 1, inner) for c in reversed(node.children)]
    return "\n".join(lines)


class _Shape:
    """A tree read back from its skeleton, with numbers for equal shapes."""

    __slots__ = ("label", "key", "children", "shape", "size")

    def __init__(self, label: str, key: int):
        self.label, self.key, self.children, self.shape, self.size = label, key, [], 0, 1


def read_skeleton(lines: str, shapes: dict) -> _Shape:
    stack: list[tuple[int, _Shape]] = []
    root = None
    order = []
    for line in lines.split("\n"):
        depth, label, key = line.split(" ")
        node = _Shape(label, int(key))
        order.append(node)
        while stack and stack[-1][0] >= int(depth):
            stack.pop()
        if stack:
            stack[-1][1].children.append(node)
        else:
            root = node
        stack.append((int(depth), node))
    for node in reversed(order):
        node.size = 1 + sum(c.size for c in node.children)
        node.shape = shapes.setdefault((node.label, tuple(c.shape for c in node.children)), len(shapes))
    return root


def _scores(a: list[_Shape], b: list[_Shape], memory: dict) -> list[list[int]]:
    """Table of simple tree matching for two lists of children."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        row, above = table[i], table[i - 1]
        for j, y in enumerate(b, 1):
            best = above[j] if above[j] > row[j - 1] else row[j - 1]
            if x.label == y.label:
                with_pair = above[j - 1] + _match(x, y, memory)
                if with_pair > best:
                    best = with_pair
            row[j] = best
    return table


def _match(x: _Shape, y: _Shape, memory: dict) -> int:
    """Nodes of the largest matching of two trees of the same label; it depends on their shapes alone."""
    if x.shape == y.shape:
        return x.size
    key = (x.shape, y.shape)
    if key not in memory:
        memory[key] = 1 + _inner(x.children, y.children, memory)[0]
    return memory[key]


def _inner(a: list[_Shape], b: list[_Shape], memory: dict) -> tuple[int, int, int, list[list[int]]]:
    """Score, equal children at the front and at the back, and the table for those between."""
    front = 0
    while front < min(len(a), len(b)) and a[front].shape == b[front].shape:
        front += 1
    back = 0
    while back < min(len(a), len(b)) - front and a[-1 - back].shape == b[-1 - back].shape:
        back += 1
    table = _scores(a[front : len(a) - back], b[front : len(b) - back], memory)
    ends = sum(x.size for x in a[:front]) + sum(x.size for x in a[len(a) - back :])
    return ends + table[-1][-1], front, back, table


def align(x: _Shape, y: _Shape, memory: dict) -> Iterator[tuple[_Shape, _Shape]]:
    """Pairs of text nodes that the matching of two trees lays upon each other."""
    stack = [(x, y)]
    while stack:
        p, q = stack.pop()
        if p.label == "#text":
            yield p, q
            continue
        a, b = p.children, q.children
        _, front, back, table = _inner(a, b, memory)
        stack += list(zip(a[:front], b[:front])) + list(zip(a[len(a) - back :], b[len(b) - back :]))
        a, b = a[front : len(a) - back], b[front : len(b) - back]
        i, j = len(a), len(b)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                stack.append((a[i], b[j]))


def _vote(group: pa.Table) -> pa.Table:
    """Of the pages of a group: per text node of the first page, how many pages were aligned with it and how many agreed."""
    host = group.column("host")[0].as_py()
    lines = [line for _, line in sorted(zip(group.column("mark").to_pylist(), group.column("skeleton").to_pylist()))]
    shapes: dict = {}
    memory: dict = {}
    first = read_skeleton(lines[0], shapes)
    votes: dict[int, list[int]] = {}
    for line in lines[1:]:
        met = {}
        for p, q in align(first, read_skeleton(line, shapes), memory):
            met[p.key] = met.get(p.key, False) or p.key == q.key
        for key, same in met.items():
            v = votes.setdefault(key, [0, 0])
            v[0] += 1
            v[1] += same
    return pa.table({"host": pa.array([host] * len(votes), pa.string()), "key": pa.array(list(votes), pa.int64()), "met": pa.array([v[0] for v in votes.values()], pa.int64()), "same": pa.array([v[1] for v in votes.values()], pa.int64())})


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: key, url, ``text`` and ``n_chars``.

    Text nodes that aligned pages of a host share belong to its template; what varies is content. That holds within a marked
    article too, but one of which nothing would be left stays whole. Names only leave out more: what calls itself a
    surrounding, and what lies outside a marked article. A host with fewer than three different other pages in a group has
    no template there. Null html counts as empty and gives an empty text; a null url has a host of its own
    with all other null urls. Null keys and repeated rows are treated as any other page (equal pages count once for a
    template), other columns are not read, an empty table gives no rows.
    """
    read = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), host_of(F.col(url)).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("text", pa.string()), ("keys", pa.list_(pa.int64())), ("main", pa.bool_())])
        for batch in batches(arrow):
            trees = [parse(h) for h in batch.column(3).to_pylist()]
            found = [[{"text": t, "keys": k, "main": m} for t, k, m in blocks(t)] for t in trees]
            bones = [skeleton(t) for t in trees]
            marks = [xxhash.xxh3_64_intdigest(b) - 2**63 for b in bones]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(item)), pa.array(bones, pa.string()), pa.array(marks, pa.int64())], ["k", "u", "host", "blocks", "skeleton", "mark"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]
    read = cut(read.mapInArrow(run, f"k {kinds[0]}, u {kinds[1]}, host string, blocks array<struct<text:string,keys:array<bigint>,main:boolean>>, skeleton string, mark bigint"))
    # copies of a page count once, before pages are counted and dealt
    counts = read.select("host", "mark").distinct().groupBy("host").agg(F.ceil(F.count("*") / GROUP_PAGES).alias("parts"))
    different = read.select("host", "mark", "skeleton").dropDuplicates(["host", "mark"])
    dealt = different.join(small(counts), "host").withColumn("part", F.pmod(F.xxhash64("mark"), F.col("parts")))
    votes = dealt.select("host", "part", "mark", "skeleton").groupBy("host", "part").applyInArrow(_vote, "host string, key long, met long, same long")
    votes = votes.groupBy("host", "key").agg(F.sum("met").alias("met"), F.sum("same").alias("same"))
    constant = cut(votes.where((F.col("met") >= LEAST_PAGES) & (F.col("same") >= CONSTANT_SHARE * F.col("met"))).select("host", "key"))
    few = constant.count() <= SMALL_ROWS
    constant = constant.groupBy("host").agg(F.collect_list("key").alias("constant"))
    met = read.select("k", "u", "host", "blocks").join(F.broadcast(constant) if few else constant, "host", "left")
    # a block is the template's if all its text nodes are; an article that would lose every block is a repeated text, no template
    voted = F.filter("blocks", lambda b: ~F.forall(b["keys"], lambda k: F.array_contains("constant", k)))
    out = met.select("k", "u", "blocks", F.when(F.col("constant").isNull(), F.col("blocks")).otherwise(voted).alias("voted"))
    whole = (F.size("voted") == 0) & F.exists("blocks", lambda b: b["main"])
    kept = F.when(whole, F.col("blocks")).otherwise(F.col("voted"))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return out.select(F.col("k").alias(key), F.col("u").alias(url), text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
