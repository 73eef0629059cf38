"""Main text of web pages, with site templates removed.

First pass: every block element's subtree of a page is hashed; Spark counts on
how many different pages of a host each hash occurs.  Hashes on a fair share
of a host's pages are that site's template.  Second pass: the page is read
again without template subtrees, scripts, styles, menus, headers, footers,
sidebars, notices, adverts, forms and comments; what is left of its article
(of the whole body when it has none) is the text.

Template subtrees are looked for outside the article, and inside it among
containers only (no paragraphs, headings or lists), so that an article which
many pages copy keeps its text.  A page that occurs many times counts once.

A class word drops block elements only, not names like ``with-sidebar``, and
never the element (or form) that holds the only article or, on pages without
one, the larger part of the text; menus, footers, asides, hidden parts and
reader comments are dropped in any case.  Parsing and hashing are linear in
the page.

Defined results: a null or empty page has empty text; character references are
decoded after the markup is read; white space inside a block becomes one
space, blocks are joined by one space; a tag that is never closed ends with
its parent; pages with a null URL share the empty host; an empty table gives
an empty table.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import urls
from sparkmart.llm.common import broadcast_checked, stored

#: A subtree is template when it is on so many pages of its host, and on this share of them.
MIN_PAGES = 5
MIN_SHARE = 0.3

#: Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select button canvas object".split())
DROPPED = frozenset("nav footer aside form dialog menu head".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tfoot tr td th br figure figcaption".split())
CONTAINERS = BLOCKS - TEXT_BLOCKS - {"html", "body", "main", "article", "hr"}
#: An opening tag of the key ends open elements of these names (up to the nearest container).
CLOSES = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"}),
}
#: Words of class, id and role values that mark parts around the article.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|cookie|cookies|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"comment|comments|reply|replies|discussion|disqus|sidebar|side|widget|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|header|masthead|footer|"
    r"related|recommended|share|sharing|social|newsletter|subscribe|subscription|signup|login|search|pagination|pager|toolbar|complementary|contentinfo)"
    r"(?:$|[\s_-])",
    re.I,
)
#: Class names that begin so say something about another part; reader comments are never the article.
OTHERS = re.compile(r"(?:no|not|non|with|without|has|have|hide|show|toggle|is)[_-]", re.I)
READERS = re.compile(r"(?:^|[\s_-])(?:comment|comments|reply|replies|discussion|disqus)(?:$|[\s_-])", re.I)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:\s|["'])hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_TAG = re.compile(r"""<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>""", re.S)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


class Node:
    __slots__ = ("name", "start", "stop", "inner", "marked", "kids")

    def __init__(self, name, start, inner, marked):
        self.name, self.start, self.inner, self.marked = name, start, inner, marked
        self.stop, self.kids = inner, []


def is_marked(name: str, attrs: str) -> str:
    """What marks an element: ``hidden``, ``readers`` (their comments), ``named``; empty if nothing does."""
    if not attrs or name in ("html", "body", "article", "main"):
        return ""
    if _HIDDEN.search(attrs):
        return "hidden"
    if name not in BLOCKS:
        return ""  # a word of a sentence isn't a part of the page
    names = [w for m in _NAMES.findall(attrs) for w in " ".join(m).split() if not OTHERS.match(w)]
    if any(READERS.search(w) for w in names):
        return "readers"
    return "named" if any(MARKED.search(w) for w in names) else ""


def parse(page: str) -> Node:
    """Element tree; kids are elements and (start, stop) spans of text."""
    root = Node("", 0, 0, "")
    stack, at, pos, n = [root], 0, 0, len(page)
    open_names: Counter = Counter()

    def close(k, end):
        while len(stack) > k:
            node = stack.pop()
            node.stop = end
            open_names[node.name] -= 1

    while m := _TAG.search(page, pos):
        if m.start() > at:
            stack[-1].kids.append((at, m.start()))
        at = pos = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if not open_names[name]:
                continue  # a stray end tag
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    ended = stack[k]
                    close(k, m.start())
                    ended.stop = m.end()
                    break
                if stack[k].name in ("article", "main", "body") and name not in ("article", "main", "body", "html"):
                    break  # a stray end tag doesn't end the article
            continue
        node = Node(name, m.start(), m.end(), is_marked(name, m[3]))
        if name in RAW:
            end = _RAW_END[name].search(page, pos)
            at = pos = node.stop = end.end() if end else n
            stack[-1].kids.append(node)
            continue
        ends = CLOSES.get(name) or (frozenset({"p"}) if name in BLOCKS and name != "br" else None)
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in ends:
                    close(k, m.start())
                    break
                if stack[k].name in CONTAINERS or stack[k].name in ("ul", "ol", "dl", "table", "article", "main", "body"):
                    break
        stack[-1].kids.append(node)
        if name not in VOID and not m[3].endswith("/"):
            stack.append(node)
            open_names[name] += 1
    if at < n:
        stack[-1].kids.append((at, n))
    close(1, n)
    root.stop = n
    return root


def _order(root: Node) -> list[tuple[Node, int]]:
    """Elements with the index of their parent, parents first."""
    out, at = [(root, -1)], 0
    while at < len(out):
        out.extend((x, at) for x in out[at][0].kids if not isinstance(x, tuple))
        at += 1
    return out


def _never(node: Node) -> bool:
    """Parts that never hold the article."""
    return node.marked in ("hidden", "readers") or node.name in RAW or (node.name in DROPPED and node.name != "form")


def kept_wrappers(page: str, root: Node) -> set[int]:
    """Ids of marked elements and forms that hold the article, or the larger part of the page's text in paragraphs.

    A name doesn't drop these.  The article is the longest one when all are in
    such elements.
    """
    nodes = _order(root)
    if not any(x.marked == "named" or x.name == "form" for x, _ in nodes):
        return set()
    size, prose, out_of = [0] * len(nodes), [False] * len(nodes), [False] * len(nodes)
    free = [True] * len(nodes)  # in no dropped part
    for i, (x, parent) in enumerate(nodes):
        out_of[i] = _never(x) or (parent >= 0 and out_of[parent])
        free[i] = not out_of[i] and not (x.marked or x.name == "form") and (parent < 0 or free[parent])
    for i in range(len(nodes) - 1, -1, -1):
        x, parent = nodes[i]
        if out_of[i]:
            continue
        size[i] += sum(len(page[t[0] : t[1]].strip()) for t in x.kids if isinstance(t, tuple))
        prose[i] |= x.name in ("p", "article", "main")
        if parent >= 0:
            size[parent] += size[i]
            prose[parent] |= prose[i]
    keep: set[int] = set()
    wanted = [i for i, (x, _) in enumerate(nodes) if x.name in ("article", "main") and not out_of[i]]
    if wanted:
        if not any(free[i] for i in wanted):
            at = max(wanted, key=lambda i: size[i])
            while at >= 0:
                keep.add(id(nodes[at][0]))
                at = nodes[at][1]
        return keep
    return {id(x) for i, (x, _) in enumerate(nodes) if prose[i] and 2 * size[i] > size[0]}


def _dropped(node: Node, inside: bool, keep: set[int]) -> bool:
    if id(node) in keep:
        return False
    return bool(node.marked) or node.name in RAW or node.name in DROPPED or (node.name == "header" and not inside)


def _articles(node: Node, keep: set[int]) -> list[Node]:
    """Outermost article (else main) elements outside dropped parts."""
    for wanted in ("article", "main"):
        found, todo = [], [node]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple) or _dropped(x, True, keep):
                continue
            if x.name == wanted:
                found.append(x)
            else:
                todo.extend(reversed(x.kids))
        if found:
            return found
    return []


def _digests(page: str, root: Node) -> dict[int, int]:
    """Hash of each element's subtree, from its tag, its texts (white space evened out) and its children's hashes."""
    out: dict[int, int] = {}
    for node, _ in reversed(_order(root)):
        parts = [" ".join(page[node.start : node.stop if node.name in RAW else node.inner].split()).encode("utf-8", "replace")]
        for x in node.kids:
            parts.append(" ".join(page[x[0] : x[1]].split()).encode("utf-8", "replace") if isinstance(x, tuple) else b"<%d" % out[id(x)])
        out[id(node)] = int.from_bytes(blake2b(b"\0".join(p for p in parts if p), digest_size=8).digest(), "little", signed=True)
    return out


def subtrees(page: str) -> list[int]:
    """Hashes of the page's subtrees that may be template."""
    root = parse(page)
    inside_of = {id(x) for x in _articles(root, kept_wrappers(page, root))}
    digests = _digests(page, root)
    out, todo = set(), [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or id(node) in inside_of
        if node.name in CONTAINERS or (not inside and node.name in TEXT_BLOCKS and node.name != "br"):
            out.add(digests[id(node)])
        todo.extend((x, inside) for x in node.kids if not isinstance(x, tuple) and x.name not in RAW)
    return sorted(out)


def main_text(page: str, template: frozenset = frozenset()) -> str:
    """Text of the page's article (or body) without dropped and template subtrees."""
    root = parse(page)
    keep = kept_wrappers(page, root)
    tops = _articles(root, keep)
    digests = _digests(page, root) if template else {}
    inside_of = {id(x) for x in tops}
    parts: list[str] = []
    # An explicit stack: elements to enter, spans and separators, the next one last.
    todo: list = []
    for top in reversed(tops or [root]):
        todo += [(top, False), " "]
    while todo:
        entry = todo.pop()
        if isinstance(entry, str):
            parts.append(entry)
            continue
        node, inside = entry
        inside = inside or id(node) in inside_of
        ahead: list = []
        for x in node.kids:
            if isinstance(x, tuple):
                ahead.append(page[x[0] : x[1]])
            elif x.name in VOID or (x.name not in BLOCKS and not x.kids):
                if x.name in ("br", "hr"):
                    ahead.append(" ")
            elif _dropped(x, inside, keep):
                if x.name in BLOCKS:
                    ahead.append(" ")
            elif template and (x.name in CONTAINERS or (not inside and x.name in TEXT_BLOCKS)) and digests[id(x)] in template:
                ahead.append(" ")
            else:
                ahead.append((x, inside))
        edge = [" "] if node.name in BLOCKS else []
        todo += [*edge, *reversed(ahead), *edge]
    return " ".join(html.unescape("".join(parts)).split())


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, hashes): the template subtrees of every host.

    The list of a host is short: each of its hashes is on ``min_share`` of its
    pages, so it has at most subtrees-per-page / ``min_share`` entries.
    """

    def hashes(batches):
        for batch in batches:
            digests, out = [], []
            for page in batch.column(1).to_pylist():
                page = page or ""
                digests.append(blake2b(page.encode("utf-8", "replace"), digest_size=16).digest())
                out.append(subtrees(page) if page else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(out, pa.list_(pa.int64()))], ["host", "digest", "hashes"])

    # A page copied many times is one page of its host.
    rows = pages.select(urls.host(F.col("url")).alias("host"), F.col("html"))
    found = rows.mapInArrow(hashes, "host string, digest binary, hashes array<long>")
    different = stored(found.groupBy("host", "digest").agg(F.first("hashes").alias("hashes")).select("host", "hashes"), "html-pages")
    sizes = different.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= min_pages)
    counts = different.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    common = counts.join(broadcast_checked(sizes, 64), "host").where(F.col("n") >= min_share * F.col("n_pages"))
    return common.groupBy("host").agg(F.array_sort(F.collect_list("hash")).alias("hashes"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    pages = pages.select("page_id", "url", "html")
    site = stored(templates(pages, min_pages, min_share), "html-templates").withColumnRenamed("host", "__host")
    n, longest = site.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("hashes")), F.lit(0))).first()
    joined = pages.join(broadcast_checked(site, 64 + 8 * longest, rows=n), urls.host(F.col("url")) == F.col("__host"), "left")

    def text(batches):
        for batch in batches:
            texts, known = [], {}
            for page, host, hashes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), strict=True):
                if host not in known:
                    known[host] = frozenset(hashes.as_py() or ())
                texts.append(main_text(page, known[host]) if page else "")
            chars = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(chars)], ["page_id", "url", "text", "n_chars"])

    rows = joined.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "__host", "hashes")
    return rows.mapInArrow(text, "page_id long, url string, text string, n_chars long")
