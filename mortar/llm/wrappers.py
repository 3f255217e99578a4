"""Main text of web pages by wrapper induction.

Pages of one host are made by one template.  Every page's DOM tree is
reduced to a skeleton (runs of like siblings folded into one).  A host's
pages are grouped by layout (the block elements they use), and aligned with
the skeleton of the layout's reference page by simple tree matching: one of
the commonest structure, never an empty page.  Counts over all distinct pages
of a layout tell which text each aligned node holds most often; where that is
on SHARE % of the aligned pages or more, the node with that text is template.
Nodes whose text varies, and nodes that have no partner, are slots.  Pages of
layouts with too few pages are aligned with the host's commonest one.

A page's text is read from its content root: its article elements where there
are any, else its main element, else the body.  Navigation, headers and footers of the
page, asides, forms, scripts, styles, and elements that name themselves
advert, notice, comment and the like are left out, and so is the template:
below a body root each of its nodes, inside an article or main element each
element whose whole text is template (a byline, a 'read more' box).  A heading
goes only with the element it is in.  Where a root has no text but template
(copies of one article), it stays whole.

Only skeletons (short, one a page) are shuffled.  The reference of a layout
with most of the pages is found and joined through partial aggregates and
``text.lookup``.

Defined cases: null and empty html have the empty text; unclosed, cut off
and wrongly nested markup is read as browsers do it, as far as it matters
for text; a null url, or one without a host, is a host of its own name ("");
a layout's template needs its text on ``MIN_PAGES`` distinct pages at least;
repeated rows each get the same result.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .text import cut, lookup

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: HTML element classes and words sites use for such parts ----
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s
samp small span strike strong sub sup time tt u var""".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table article section div body html td th main aside nav form blockquote".split())
NOT_TEXT = frozenset("""head script style title template noscript textarea select option button form iframe svg math
object canvas audio video map nav aside footer dialog menu datalist noembed noframes xmp""".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
NAMES = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar
menu navbar navigation nav breadcrumb breadcrumbs footer masthead cookie cookies consent notice notices gdpr popup modal
overlay newsletter subscribe subscription signup share sharing social related recommended comment comments comentarios
kommentare commentaires disqus respond reply replies widget pagination pager toolbar skip""".split())
HEADER_NAMES = frozenset("header topbar".split())
NAME_STARTS = tuple("comment advert adsby sponsor cookie sidebar newsletter breadcrumb footer masthead subscri".split())
ARTICLE_NAMES = frozenset("ad ads advert comment comments promo related sponsored teaser".split())
BOX_WORDS = frozenset("""area bar block box button buttons container content form inner item items links list posts
section widget wrap wrapper""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = frozenset("article main".split())
# --- end of fixed values ------------------------------------------------------

# Siblings of these elements are folded whenever they follow each other, those of
# others (parts of a layout) in runs of more than RUN.
LISTED = frozenset("p li tr td th dt dd option h1 h2 h3 h4 h5 h6 figure blockquote pre".split())
RUN = 12
# Elements nested deeper are read as children of the last level.
DEPTH = 200

MIN_PAGES = 3
# A node is template where this percentage of the aligned pages has its commonest text.
SHARE = 90
# Of references whose structures are equally common, the longer one up to this length.
LONG_SKELETON = 8192
MAX_WRAPPER_BYTES = 32 << 20

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
BLANKS = re.compile("[ \t\n\x0b\x0c\r]+")


class Node:
    __slots__ = ("tag", "attrs", "items", "number")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.items, self.number = tag, attrs, [], -1

    def attributes(self) -> dict[str, str]:
        out = {}
        for name, value in ATTRIBUTE.findall(self.attrs):
            out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
        return out


def parse(source: str) -> Node:
    """The DOM tree: items of a node are texts and nodes in page order."""
    root = Node("#root")
    stack = [root]
    at, size = 0, len(source)
    while at < size:
        m = TOKEN.search(source, at)
        if m is None:
            tail = source[at:]
            cut_off = re.search(r"<[A-Za-z/!][^>]*\Z", tail)  # a tag that the end of the page cuts off
            stack[-1].items.append(tail[:cut_off.start()] if cut_off else tail)
            break
        if m.start() > at:
            stack[-1].items.append(source[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        tag = name.lower()
        if m.group(1):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag not in INLINE and tag != "br" and tag not in RAW:
            _close(stack, ("p",), SCOPE)
        if tag in CLOSES:
            _close(stack, CLOSES[tag], frozenset(("ul", "ol", "dl", "table", "select")))
        node = Node(tag, m.group(3))
        stack[-1].items.append(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(source, at)
            at = end.start() if end else size
        elif tag not in VOID and len(stack) < DEPTH and (not m.group(3).endswith("/") or tag in INLINE | {"p", "div"}):
            stack.append(node)  # (browsers ignore the slash of ordinary elements)
    return root


def _close(stack: list[Node], tags: tuple[str, ...], until: frozenset) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in until:
            return


def is_aside(node: Node, inside: bool) -> bool:
    """Whether an element holds no main text; ``inside`` the content root headers do."""
    if node.tag in NOT_TEXT or (node.tag == "header" and not inside):
        return True
    if not node.attrs.strip():
        return False
    attrs = node.attributes()
    if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", attrs.get("style", "").lower()):
        return True
    if node.tag in ("html", "body", "main"):
        return False
    if node.tag == "article":
        return bool(_words(attrs.get("class", "") + " " + attrs.get("id", "")) & ARTICLE_NAMES)
    if inside or node.tag in HEADINGS:
        # ids and classes made from titles hold such words too: only a whole one counts, and no heading's id
        return (any(_is_name(c, BOX_WORDS) for c in attrs.get("class", "").split())
                or (node.tag not in HEADINGS and _is_name(attrs.get("id", ""), frozenset())))
    words = _words(attrs.get("class", "") + " " + attrs.get("id", ""))
    return any(map(_names_aside, words)) or bool(words & HEADER_NAMES)


def _words(name: str) -> set[str]:
    return set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())) - {""}


def _names_aside(word: str) -> bool:
    return word in NAMES or (word.startswith(NAME_STARTS) and word != "commentary")


def _is_name(name: str, besides: frozenset) -> bool:
    """Whether a whole class or id says aside: every word does, or is one of ``besides``."""
    words = _words(name)
    return any(map(_names_aside, words)) and all(_names_aside(w) or w in besides for w in words)


def nodes_of(node: Node) -> list[Node]:
    return [i for i in node.items if isinstance(i, Node)]


def skeleton(root: Node) -> list:
    """[tag, digest of the own texts, children] with runs of like siblings folded; numbers the nodes."""
    count = 0

    def texts(node: Node) -> str:
        return BLANKS.sub(" ", " ".join(i for i in node.items if isinstance(i, str))).strip()

    def build(members: list[Node]) -> list:
        nonlocal count
        own = " ".join(filter(None, (texts(m) for m in members)))
        mine = count
        count += 1
        for m in members:
            m.number = mine
        children, groups = [n for m in members for n in nodes_of(m)], []
        for child in children:
            if child.tag in INLINE or child.tag in VOID:
                child.number = mine
                continue
            if groups and groups[-1][0].tag == child.tag and groups[-1][0].attrs == child.attrs:
                groups[-1].append(child)
            else:
                groups.append([child])
        inline = " ".join(plain_text(c) for c in children if c.tag in INLINE)
        groups = [part for g in groups for part in (
            [g] if g[0].tag in LISTED or len(g) > RUN else [[n] for n in g])]
        mark = hashlib.blake2b((own + "\0" + inline).encode("utf-8", "replace"), digest_size=6).hexdigest() \
            if own or inline else ""
        return [members[0].tag, mark, mine, [build(g) for g in groups]]

    return build([root])


def plain_text(node: Node) -> str:
    return " ".join(i if isinstance(i, str) else plain_text(i) for i in node.items)


def match_trees(a: list, b: list, pairs: list | None = None) -> int:
    """Simple tree matching: size of the best order-preserving alignment; appends (a, b) node pairs.

    A score depends on the shapes of two subtrees (tags and their order) only,
    so each pair of shapes is aligned once and equal shapes match whole.  Equal
    shapes at both ends of two child lists are matched without a table, which
    loses nothing: no partner fits a subtree better than its equal.  The table
    of what lies between is filled by whole rows; two bits a cell are kept.
    """
    ids: dict[tuple, int] = {}
    kinds: list[tuple] = []
    sizes: list[int] = []
    aligned: dict[tuple[int, int], tuple] = {}

    def shapes(node: list, out: dict[int, int]) -> int:
        key = node[0], tuple(shapes(child, out) for child in node[3])
        if key not in ids:
            ids[key] = len(kinds)
            kinds.append(key)
            sizes.append(1 + sum(sizes[k] for k in key[1]))
        out[node[2]] = ids[key]
        return ids[key]

    def score(x: int, y: int) -> int:
        if x == y:
            return sizes[x]
        if kinds[x][0] != kinds[y][0]:
            return 0
        if (x, y) not in aligned:
            aligned[x, y] = align(kinds[x][1], kinds[y][1])
        return aligned[x, y][0]

    def align(p: tuple, q: tuple) -> tuple:
        """(score, equal children at the begin, at the end, rows of the table between)."""
        short, first, last = min(len(p), len(q)), 0, 0
        while last < short and p[-1 - last] == q[-1 - last]:
            last += 1
        while first < short - last and p[first] == q[first]:
            first += 1
        whole = 1 + sum(sizes[k] for k in (*p[:first], *p[len(p) - last:]))
        p, q = p[first:len(p) - last], q[first:len(q) - last]
        if not p or not q:
            return whole, first, last, []
        different, place = np.unique(np.array(q), return_inverse=True)
        different = different.tolist()
        above, rows = np.zeros(len(q) + 1, np.int64), []
        for k in p:
            line = np.array([score(k, other) for other in different])[place]
            both = np.where(line > 0, above[:-1] + line, 0)
            row = np.maximum.accumulate(np.maximum(above[1:], both))
            rows.append((np.packbits((line > 0) & (row == both)), np.packbits(row == above[1:])))
            above[1:] = row
        return whole + int(above[-1]), first, last, rows

    def bit(bits: np.ndarray, at: int) -> bool:
        return bool(bits[at >> 3] >> (7 - (at & 7)) & 1)

    def trace(x: list, y: list) -> None:
        pairs.append((x, y))
        p, q, key = x[3], y[3], (in_a[x[2]], in_b[y[2]])
        first, last, rows = (0, len(p), []) if key[0] == key[1] else aligned[key][1:]
        i, j = len(p) - last, len(q) - last
        for m, n in zip(reversed(p[i:]), reversed(q[j:])):
            trace(m, n)
        while i > first and j > first:
            match, up = rows[i - first - 1]
            if bit(match, j - first - 1):
                i, j = i - 1, j - 1
                trace(p[i], q[j])
            elif bit(up, j - first - 1):
                i -= 1
            else:
                j -= 1
        for m, n in zip(reversed(p[:first]), reversed(q[:first])):
            trace(m, n)

    in_a: dict[int, int] = {}
    in_b: dict[int, int] = {}
    best = score(shapes(a, in_a), shapes(b, in_b))
    if best and pairs is not None:
        trace(a, b)
    return best


def main_text(root: Node, template: set[int]) -> str:
    """Blocks of the content root joined by line breaks; ``template`` are node numbers to leave out."""
    def find(node: Node, tag: str) -> list[Node]:
        out = []
        for child in nodes_of(node):
            if not is_aside(child, False):
                found = child.tag == tag or child.attributes().get("role", "").lower() == tag
                out += [child] if found else find(child, tag)
        return out

    roots = find(root, "article") or find(root, "main")
    bodies = roots or [root]
    kinds: dict[int, tuple[bool, bool]] = {}

    def kind(node: Node) -> tuple[bool, bool]:
        """Whether the element holds text that is template, and text that is not (its own inline text included)."""
        if id(node) not in kinds:
            same = other = False
            for item in node.items:
                if isinstance(item, str):
                    full = bool(html.unescape(item).strip(" \t\n\x0b\x0c\r"))
                    same, other = same or full and node.number in template, other or full and node.number not in template
                elif item.tag in INLINE:
                    full = bool(html.unescape(plain_text(item)).strip(" \t\n\x0b\x0c\r"))
                    same, other = same or full and node.number in template, other or full and node.number not in template
                elif not is_aside(item, True):
                    more = kind(item)
                    same, other = same or more[0], other or more[1]
            kinds[id(node)] = same, other
        return kinds[id(node)]

    # roots that hold nothing but template are copies of one article
    varies = bool(roots) and any(kind(r)[1] for r in roots)
    blocks: list[str] = []
    now: list[str] = []

    def flush() -> None:
        text = BLANKS.sub(" ", html.unescape("".join(now))).strip(" \t\n\x0b\x0c\r")
        if text:
            blocks.append(text)
        now.clear()

    def walk(node: Node) -> None:
        drop = not roots and node.number in template
        for item in node.items:
            if isinstance(item, str):
                if not drop:
                    now.append(item)
            elif item.tag == "br":
                now.append(" ")
            elif is_aside(item, bool(roots)):
                if item.tag not in INLINE:
                    flush()
            elif item.tag in INLINE or item.tag in VOID:
                walk(item)
            elif varies and item.tag not in HEADINGS and kind(item) == (True, False):
                flush()
            else:
                flush()
                walk(item)
                flush()

    for body in bodies:
        flush()
        walk(body)
        flush()
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)), F.lit(""))


def layout_of(source: Column) -> Column:
    """Layout key of a page: which block elements it has, and the first named div or body; null without any markup."""
    page = F.lower(source)
    tags = F.array_sort(F.array_distinct(F.regexp_extract_all(
        page, F.lit(r"<(article|main|section|table|div|center|frameset|header|nav|aside|footer|form)\b"), F.lit(1))))
    name = F.regexp_replace(F.regexp_extract(
        page, r"<(?:div|body)\b[^>]*?\s(?:class|id)\s*=\s*[\"']?([^\"'>]*)", 1), "[0-9]+", "")
    return F.when(page.rlike("<[a-z]"), F.xxhash64(F.concat_ws(" ", tags), name))


def _key(host: Column, layout: Column) -> Column:
    """Key of a host's layout; a null layout stands for the host's commonest one."""
    return F.concat(host, F.lit("\n"), F.coalesce(layout.cast("string"), F.lit("*")))


def structure(bones: list) -> str:
    """Digest of a skeleton's tags."""
    def tags(node: list) -> str:
        return f"{node[0]}({' '.join(map(tags, node[3]))})"
    return hashlib.blake2b(tags(bones).encode("utf-8", "replace"), digest_size=8).hexdigest()


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [skeleton(parse(h.as_py() or "")) for h in batch.column("html")]
        rows = pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("layout"), batch.column("page_id"),
             pa.array([structure(m) for m in made], pa.string()),
             pa.array([json.dumps(m, separators=(",", ":")) for m in made], pa.string())],
            names=["host", "layout", "page_id", "structure", "skeleton"])
        yield rows.filter(pa.array([bool(m[3]) for m in made], pa.bool_()))


def _alignments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, mark, n): counts of a batch's pages by the text at the reference's nodes ("": none)."""
    for batch in batches:
        counts: Counter = Counter()
        references: dict[str, list] = {}
        for key, mine, other in zip(*[batch.column(c).to_pylist() for c in ("key", "skeleton", "reference")]):
            if other not in references:
                references[other] = json.loads(other)
            pairs: list = []
            match_trees(references[other], json.loads(mine), pairs)
            for x, y in pairs:
                counts[key, x[2], y[1]] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
            pa.array([k[2] for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())],
            names=["key", "node", "mark", "n"])


def induce(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(key, reference, constant, n): per layout its reference skeleton and the template's "node text-digest"s.

    A host's commonest layout is there a second time, with the host's key for all other pages.
    """
    rows = pages.select(host_of(F.col("url")).alias("host"), layout_of(F.col("html")).alias("layout"), "page_id", "html")
    bones = cut(rows.where(F.col("layout").isNotNull()).mapInArrow(
        _skeletons, "host string, layout long, page_id long, structure string, skeleton string")
        .groupBy("host", "layout", "structure", "skeleton").agg(F.min("page_id").alias("page_id")))
    first = F.struct("page_id", "skeleton")
    alike = bones.groupBy("host", "layout", "structure").agg(
        F.min_by("skeleton", first).alias("skeleton"), F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n"))
    layouts = alike.groupBy("host", "layout").agg(
        F.max_by("skeleton", F.struct("n", F.least(F.length("skeleton"), F.lit(LONG_SKELETON)).alias("size"),
                                      (-F.col("page_id")).alias("first"), "skeleton")).alias("reference"),
        F.sum("n").alias("n"))
    layouts = cut(layouts)
    hosts = cut(layouts.groupBy("host").agg(
        F.max(F.struct("n", "layout", "reference")).alias("best"), F.sum("n").alias("pages")))
    # which reference counts a page: its own layout's if that has enough pages, the
    # host's if no layout of it has; odd pages beside a common layout are not counted
    own = layouts.where(F.col("n") >= min_pages).select(_key(F.col("host"), F.col("layout")).alias("key"), "reference", "n")
    few = hosts.where(F.col("best.n") < min_pages).select(
        _key(F.col("host"), F.lit(None)).alias("key"), F.col("best.reference").alias("reference"), F.col("pages").alias("n"))
    groups = cut(own.union(few))
    small = hosts.where(F.col("best.n") < min_pages).select("host", F.lit(True).alias("small"), F.col("pages").alias("n"))
    marked = lookup(bones, cut(small), "host", "n", [F.col("skeleton")]).select(
        _key(F.col("host"), F.when(F.col("small").isNull(), F.col("layout"))).alias("key"), "skeleton")
    paired = lookup(marked, groups, "key", "n", [F.col("skeleton")]).where(F.col("reference").isNotNull())
    counted = paired.select("key", "skeleton", "reference").mapInArrow(
        _alignments, "key string, node int, mark string, n long")
    nodes = counted.groupBy("key", "node", "mark").agg(F.sum("n").alias("n")).groupBy("key", "node").agg(
        F.sum("n").alias("aligned"), F.max(F.when(F.col("mark") != "", F.struct("n", "mark"))).alias("most"))
    constant = nodes.where((F.col("most.n") * 100 >= F.col("aligned") * SHARE) & (F.col("most.n") >= min_pages)).groupBy(
        "key").agg(F.sort_array(F.collect_set(F.concat_ws(" ", "node", "most.mark"))).alias("constant"))
    made = cut(groups.join(constant, "key").select("key", "reference", "constant", "n"))
    best = hosts.where(F.col("best.n") >= min_pages).select(
        _key(F.col("host"), F.col("best.layout")).alias("key"), _key(F.col("host"), F.lit(None)).alias("all"))
    return made.union(made.join(best, "key").select(F.col("all").alias("key"), "reference", "constant", "n"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    references: dict[str, list] = {}
    for batch in batches:
        out = []
        for source, reference, constant in zip(
                batch.column("html"), batch.column("reference"), batch.column("constant")):
            root = parse(source.as_py() or "")
            template: set[int] = set()
            reference = reference.as_py()
            bones = skeleton(root)
            if reference is not None:
                if reference not in references:
                    if len(references) > 1000:
                        references.clear()
                    references[reference] = json.loads(reference)
                fixed, pairs = dict(c.split(" ") for c in constant.as_py()), []
                match_trees(references[reference], bones, pairs)
                template = {y[2] for x, y in pairs if fixed.get(str(x[2])) == y[1]}
            out.append(main_text(root, template))
        rest = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in ("html", "reference", "constant")]
        names = [n for n in batch.schema.names if n not in ("html", "reference", "constant")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(out, pa.string())], names=[*names, "text"])


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``."""
    pages = pages.select("page_id", "url", "html")
    wrappers = cut(induce(pages, min_pages))
    size = wrappers.agg(F.sum(F.length("reference") + 20 * F.size("constant"))).first()[0] or 0
    joined = pages.withColumns({"host": host_of(F.col("url")), "layout": layout_of(F.col("html"))})
    found = []
    for i, layout in enumerate((F.col("layout"), F.lit(None))):  # of the page's own layout, else of the host
        key, reference, constant = f"key{i}", f"reference{i}", f"constant{i}"
        joined = joined.withColumn(key, _key(F.col("host"), layout))
        one = wrappers.select(F.col("key").alias(key), F.col("reference").alias(reference),
                              F.col("constant").alias(constant), F.col("n").alias(f"n{i}"))
        if size <= MAX_WRAPPER_BYTES:
            joined = joined.join(F.broadcast(one), key, "left")
        else:
            joined = lookup(joined, one, key, f"n{i}", [F.col("page_id")])
        found.append((F.col(reference), F.col(constant)))
    joined = joined.select("page_id", "url", "html", F.coalesce(found[0][0], found[1][0]).alias("reference"),
                           F.coalesce(found[0][1], found[1][1]).alias("constant"))
    schema = "page_id long, url string, text string"
    return joined.select("page_id", "url", "html", "reference", "constant").mapInArrow(_texts, schema)


def text_digest(pages: DataFrame) -> DataFrame:
    """The contract's columns: page_id, url, text, n_chars."""
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
