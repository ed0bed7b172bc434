"""Main text of pages: wrappers induced per host, and the roles that markup itself gives.

Every page becomes a tree of its block elements. A host's pages are aligned with one page
of it, its seed, by simple tree matching; matched blocks share a slot. A slot whose text is the
same on most of a host's different pages is template, all else is content. What the
markup marks as something else (menus, forms, adverts, comments, ...) is never content.
"""

from __future__ import annotations

import collections
import functools
import html
import re
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources import stage

#: A slot is template from this share of a host's different pages on, and from this many pages on.
SHARE, LEAST_PAGES = 0.6, 4

# Element names and words by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|iframe|textarea|title|svg|math|select|object|canvas|audio|video"
BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot
    th thead tr ul caption""".split()
)
NOT_TEXT = frozenset("aside button dialog footer form head menu nav search datalist".split())
CLOSES_P = BLOCK - frozenset("html head body".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}}
SCOPES = frozenset("ul ol dl table article section div main body html".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_BEFORE = "(?:(?:site|page|top|bottom|main|left|right|global|post|article|user|reader|cookie|blog|widget|js|sticky)[-_]*)*"
#: Words that name a role whatever follows them.
ROLE_WORDS = r"""ads?|adv|advert\w*?|adsense|banners?|sponsor[a-z]*|promo[a-z]*|sidebars?|nav|navbar|navigation|navi|menus?|menubar
    |breadcrumbs?|footers?|masthead|topbar|cookies?|consent|gdpr|popups?|newsletter|subscri[a-z]*|commentlist|disqus
    |toolbar|pagination|outbrain|taboola"""
#: Words that also occur in names of articles; they name a role alone or with the endings below.
WEAK_WORDS = r"""side|aside|foot|notices?|modal|overlay|alerts?|signup|social|share|sharing|related|recommend[a-z]*|comments?|respond
    |replies|reply|widgets?|pager|copyright|legal|disclaimer|login|search|skip|toc|tags?"""
ENDINGS = r"""ad|area|articles?|bar|block|box|btn|buttons?|column|container|content|cloud|counts?|field|form|group|header|icons?|inner|input
    |items?|links?|lists?|menu|message|nav|notice|outer|overlay|panel|popup|posts|row|section|sidebar|stories|text|thread|title|to|widgets?
    |wrap|wrapper|\d+"""
NAMES = re.compile(rf"{_BEFORE}(?:(?:{ROLE_WORDS})(?:[-_]+[^\W_]+)*|(?:{WEAK_WORDS})(?:[-_]+(?:{ENDINGS}))*)[-_]*", re.X | re.I)
HEADER_NAMES = re.compile(r"(?:(?:site|page|top|main|global)[-_]*)?(?:header|head)(?:[-_]+[^\W_]+)*[-_]*", re.I)

# A quote that does not close before a space, a slash or the tag's end is an ordinary character; a tag that does not
# end gives up at the next "<". So each character is read a fixed number of times, whatever the markup is.
_ATTRS = r"""(?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')(?=[\s/>])|=)*+"""
_END = r"(?:>|(?=<)|\Z)"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/<>]|\Z){_ATTRS}{_END}.*?(?:</(?P=raw)\s*+>|\Z)"
    rf"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<attrs>{_ATTRS}){_END}"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s=/"'<>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_ROLE_ATTRS = frozenset("class id role hidden style aria-hidden".split())
_SPACE = re.compile(r"\s+")


def _about(tag: str, attrs: str, in_article: bool) -> tuple[str, bool]:
    """:func:`_role`, from memory for attributes of ordinary length."""
    return _role(tag, attrs, in_article) if len(attrs) < 512 else _role.__wrapped__(tag, attrs, in_article)


@functools.lru_cache(maxsize=4096)
def _role(tag: str, attrs: str, in_article: bool) -> tuple[str, bool]:
    """(label for matching, whether it is marked as something other than main text)."""
    found = {}
    for m in _ATTR.finditer(attrs):
        if m[1].lower() in _ROLE_ATTRS:
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    label = tag + "." + re.sub(r"[^A-Za-z_-]", "", found.get("class", "").partition(" ")[0])
    if tag in NOT_TEXT or (tag == "header" and not in_article):
        return label, True
    if tag in ("html", "body", "main"):
        return label, False
    other = "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES
    other = other or "display:none" in found.get("style", "").replace(" ", "").lower()
    other = other or any(NAMES.fullmatch(x) for x in names) or (not in_article and any(HEADER_NAMES.fullmatch(x) for x in names))
    return label, other


def parsed(page: str) -> tuple[list[tuple[int, str]], list[tuple[int, int, bool, str]]]:
    """The tree of block elements as (depth, label) in page order, and the blocks of text that may be content:
    (node, region, whether all in links, text). Region: the number of the article or main element around it, or -1."""
    tree: list[tuple[int, str]] = []
    blocks: list[tuple[int, int, bool, str]] = []
    stack: list[tuple[str, int, bool, int]] = [("", -1, False, -1)]  # tag, node, not text, region
    buffer: list[str] = []
    linked = 0  # characters of the buffer inside links
    link = 0  # how many elements were open where the open link began; 0 outside links
    open_tags: collections.Counter[str] = collections.Counter()
    regions = 0

    def flush():
        nonlocal linked
        if buffer:
            tag, node, other, region = stack[-1]
            if not other:
                text = _SPACE.sub(" ", html.unescape("".join(buffer))).strip()
                if text:
                    blocks.append((node, region, 2 * linked > len(text), text))
            buffer.clear()
        linked = 0

    def leave(names, scope=SCOPES) -> None:
        """Closes the innermost open element of these names, unless one of ``scope`` lies between. A link ends with its block."""
        nonlocal link
        if not any(open_tags[name] for name in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                flush()
                open_tags.subtract(x[0] for x in stack[k:])
                del stack[k:]
                if link > len(stack):
                    link = 0
                return
            if stack[k][0] in scope:
                return

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            buffer.append(piece)
            if link:
                linked += len(piece.strip())
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            buffer.append(" ")
        elif tag == "a":
            link = 0 if m["close"] else len(stack)
        elif tag not in BLOCK and tag not in NOT_TEXT:
            continue
        elif m["close"]:
            leave((tag,), ())
        else:
            flush()
            if tag in CLOSES_P:
                leave(("p",))
            if tag in SIBLINGS:
                leave(SIBLINGS[tag], SCOPES)
            if tag == "hr":
                continue
            _, _, other, region = stack[-1]
            label, marked = _about(tag, m["attrs"], region >= 0)
            if not (other or marked) and tag in ("article", "main") and region < 0:
                region, regions = regions, regions + 1
            tree.append((len(stack) - 1, label))
            stack.append((tag, len(tree) - 1, other or marked, region))
            open_tags[tag] += 1
    buffer.append(page[at:])
    flush()
    return tree, blocks


class _Node:
    __slots__ = ("label", "place", "children", "shape", "size")

    def __init__(self, label: str, place: int):
        self.label, self.place, self.children = label, place, []


def _grown(tree) -> _Node:
    root = _Node("", -1)
    path = [root]
    for place, (depth, label) in enumerate(tree):
        node = _Node(label, place)
        del path[depth + 1 :]
        path[-1].children.append(node)
        path.append(node)
    order = [root]
    for node in order:
        order.extend(node.children)
    for node in reversed(order):
        node.shape = hash((node.label, *[c.shape for c in node.children]))
        node.size = 1 + sum(c.size for c in node.children)
    return root


def _matched(a: _Node, b: _Node, slots: dict[int, int]) -> None:
    """Simple tree matching of two trees with equal roots: fills place in ``a`` to place in ``b``."""
    memo: dict[tuple[int, int], int] = {}

    def middle(x: _Node, y: _Node) -> tuple[int, int, list[_Node], list[_Node]]:
        """How many children are alike at the begin and at the end, and the children between."""
        p, q = x.children, y.children
        head = 0
        while head < len(p) and head < len(q) and p[head].shape == q[head].shape:
            head += 1
        tail = 0
        while tail < min(len(p), len(q)) - head and p[-1 - tail].shape == q[-1 - tail].shape:
            tail += 1
        return head, tail, p[head : len(p) - tail], q[head : len(q) - tail]

    def known(c: _Node, d: _Node) -> int | None:
        if c.label != d.label:
            return 0
        return c.size if c.shape == d.shape else memo.get((c.place, d.place))

    def table(x: _Node, y: _Node):
        """The table of the children's best matching, after those of all children that it needs; deep trees need no recursion."""
        needed = [(x, y)]
        while True:
            u, v = needed[-1]
            head, tail, p, q = middle(u, v)
            missing = [(c, d) for c in p for d in q if known(c, d) is None]
            if missing:
                needed += missing
                continue
            rows = [[0] * (len(q) + 1)]
            for c in p:
                before, row = rows[-1], [0]
                for k, d in enumerate(q):
                    row.append(max(before[k + 1], row[k], before[k] + known(c, d)))
                rows.append(row)
            same = sum(c.size for c in u.children[:head]) + sum(c.size for c in u.children[len(u.children) - tail :])
            memo[u.place, v.place] = 1 + same + rows[-1][-1]
            needed.pop()
            if not needed:
                return head, tail, p, q, rows

    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        slots[x.place] = y.place
        if x.shape == y.shape:
            todo.extend(zip(x.children, y.children, strict=True))
            continue
        head, tail, p, q, rows = table(x, y)
        todo.extend(zip(x.children[:head], y.children[:head], strict=True))
        if tail:
            todo.extend(zip(x.children[-tail:], y.children[-tail:], strict=True))
        i, j = len(p), len(q)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((p[i], q[j]))


def _written(tree) -> str:
    return "|".join(f"{depth}:{label}" for depth, label in tree)


@functools.lru_cache(maxsize=256)
def _read(text: str) -> _Node:
    return _grown([(int(x.partition(":")[0]), x.partition(":")[2]) for x in text.split("|")] if text else [])


def _host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


_PARSED = "page_id bigint, url string, host string, tree string, nodes array<int>, regions array<int>, links array<boolean>, texts array<string>"


def _parse(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            out = {k: [] for k in ("tree", "nodes", "regions", "links", "texts")}
            for page in part.column("html"):
                tree, blocks = parsed(page.as_py() or "")
                out["tree"].append(_written(tree))
                for name, values in zip(("nodes", "regions", "links", "texts"), zip(*blocks, strict=True) if blocks else [()] * 4, strict=True):
                    out[name].append(list(values))
            kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.string())]
            hosts = pa.array([_host(u) for u in part.column("url").to_pylist()], pa.string())
            arrays = [part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()), hosts, *[pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "host", *out])


def _keys(row: dict) -> list[int]:
    """For each block of a page, a key of its slot and text."""
    slots: dict[int, int] = {}
    _matched(_grown([(int(x.partition(":")[0]), x.partition(":")[2]) for x in row["tree"].split("|")] if row["tree"] else []), _read(row["seed"]), slots)
    return [xxhash.xxh64_intdigest(f"{slots.get(node, -2)}\n{text}") - 2**63 for node, text in zip(row["nodes"], row["texts"], strict=True)]


def _slots(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            rows = part.select(["tree", "seed", "nodes", "texts", "regions"]).to_pylist()
            keys = [sorted(set(_keys(r))) for r in rows]
            body = [xxhash.xxh64_intdigest("\n".join(t for t in r["texts"] if len(t) > 80) or "\n".join(r["texts"])) - 2**63 for r in rows]
            yield pa.RecordBatch.from_arrays([part.column("host"), pa.array(body, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["host", "body", "keys"])


def _extract(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = []
            for r in part.to_pylist():
                template = set(r["template"] or ())
                keys = _keys(r) if template else [0] * len(r["texts"])
                inside = max(r["regions"], default=-1) >= 0
                kept = [t for t, k, g, link in zip(r["texts"], keys, r["regions"], r["links"], strict=True) if k not in template and (g >= 0 if inside else not link)]
                texts.append("\n\n".join(kept))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_text(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block is one space, blocks are
    joined in page order by two line breaks. With article or main elements that hold text the text is that of all of
    them that are not marked as something else, otherwise that of all blocks that are not made of links. Slots whose
    text is the same on ``share`` of a host's different pages are left out, if these are ``least_pages`` or more;
    pages with the same long blocks count as one.

    NULL and empty pages give an empty text. A NULL or odd url is the host ''. Repeated rows
    get equal answers. Broken markup is read as far as it goes. Other columns are not read.
    """
    rows = stage(pages.select("page_id", "url", "html").mapInArrow(_parse, _PARSED))
    seeds = stage(rows.groupBy("host").agg(F.min_by("tree", F.struct(F.xxhash64("page_id", "url"), "tree")).alias("seed")))
    slots = rows.join(seeds, "host").mapInArrow(_slots, "host string, body bigint, keys array<bigint>")
    once = stage(slots.groupBy("host", "body").agg(F.min("keys").alias("keys")))
    size = once.groupBy("host").agg(F.count("*").alias("pages"))
    often = once.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n"))
    constant = often.where(F.col("n") >= least_pages).join(size, "host").where(F.col("n") >= share * F.col("pages"))
    # a host has at most (blocks of a page / share) constant slots
    templates = stage(constant.groupBy("host").agg(F.collect_list("key").alias("template")))
    wrappers = stage(seeds.join(templates, "host", "left"))
    text = rows.join(wrappers, "host").mapInArrow(_extract, "page_id bigint, url string, text string")
    return text.withColumn("n_chars", F.length("text").cast("bigint"))
