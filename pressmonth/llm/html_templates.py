"""Main text of web pages by removal of site templates.

Every element subtree (tag, text and children) is hashed; Spark counts on how many distinct pages of a host each hash
occurs: copies of a page count once, whatever the host's size.  Subtrees that recur on many pages of their host are the
host's template and are deleted.  If a page has an article (or main) element, only that is read, and only what recurs
inside the host's articles is deleted from it: a box (div, section, list, table) that three of ten different articles
hold, and a block of text (paragraph, heading, item) that nine of ten hold; what fewer share is content.  Outside
articles a box needs one of a hundred pages and a block of text one of fifty, or fifty pages.  An element with half of
the text of its page or article is never deleted by counts, so one story on several pages stays.  Elements
whose tag, role or class names them as menus, headers, footers, sidebars, notices, adverts, forms, comments or markup
are deleted on every page, as are scripts and styles, so pages of small hosts lose theirs too.  Inside an article a
class or id counts only if all its words name such parts; outside, one word is enough, unless the element holds an
article or half of the page's text.  The page, body, article and main elements are never deleted by a name.

A null or empty html has the text "" and no template.  Equal pages get equal texts; pages without a url share the
empty host; an empty table gives no rows.  A host's template is sorted before its pages, not joined to each of them; the
pages of a large host are dealt over as many tasks as their number asks for.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmonth.llm.arrays import slices
from pressmonth.llm.staging import staged, widened

MIN_PAGES, MIN_SHARE = 5, 0.02
BOX_SHARE = 0.01  # of a host's distinct pages, for a box outside articles
ARTICLE_SHARE, ARTICLE_BOX_SHARE = 0.9, 0.3  # of a host's distinct articles: fewer may share a text or box that is content
MANY_PAGES = 50  # a subtree outside articles on so many pages needs no share of its host
PAGES_TOGETHER = 100  # of one host

# Names of the HTML standard, and usual names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROPPED = frozenset(
    "head script style noscript template nav footer aside form iframe svg math object embed button select textarea "
    "dialog menu title canvas audio video map xmp noembed noframes".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
# what counts can delete, and what of it is a block of text, which may recur by chance
COUNTED = BLOCKS - {"html", "body", "article", "main", "br", "hr"}
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr tbody thead tfoot figcaption caption legend option summary".split())
BOILERPLATE = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent notice "
    "popup modal overlay sidebar side nav navbar navigation menu menubar breadcrumb breadcrumbs footer header masthead "
    "topbar toolbar comment comments disqus reply replies respond share sharing social related recommended newsletter "
    "subscribe subscription signup login form widget pagination pager skip toc".split()
)
AMBIGUOUS = frozenset("header side".split())  # inside an article these name its own parts
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
CLOSES_P = BLOCKS - {"br", "hr", "body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"} | {"hr"}
SIBLINGS = {  # an opening tag that ends an open element of these names, up to the container
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_PIECES = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z][^\s/>]*+(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+(?:>|\Z)|[^<]+|<", re.DOTALL
)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Node:
    tag: str
    dropped: bool = False
    children: list = field(default_factory=list)  # nodes and strings
    hash: int = 0
    first: int = 0  # the lines of the page that the element holds
    stop: int = 0
    size: int = 0  # characters of its text


def _is_boilerplate(tag: str, piece: str, in_article: bool) -> tuple[bool, bool]:
    """(dropped, only by a part of a name): the page, its articles and main parts are never dropped by a name."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True, False
    if tag in ("html", "body", "article", "main"):
        return False, False
    hinted = False
    for name, *values in _MARKS.findall(piece):
        value = next((v for v in values if v), "")
        if name.lower() == "role":
            if value.lower() in ROLES:
                return True, False
            continue
        for token in value.split():
            parts = [part.lower() for part in _PARTS.split(token) if part]
            if parts and all(p in BOILERPLATE for p in parts) and not (in_article and AMBIGUOUS.issuperset(parts)):
                return True, False
            hinted = hinted or any(p in BOILERPLATE for p in parts)
    if "hidden" in piece and re.search(r"\s(?:hidden|aria-hidden\s*=\s*[\"']?true)\b", piece):
        return True, False
    return (hinted, True) if not in_article else (False, False)


def _keep_wrappers(root: Node, hinted: list[Node]) -> None:
    """An element dropped for a part of a name stays if it holds an article, a main part or half of the page's text."""
    if not hinted:
        return
    sizes: dict[int, tuple[int, bool]] = {}
    stack: list[tuple[Node, bool]] = [(root, False)]
    suspects = {id(n) for n in hinted}
    while stack:
        node, ready = stack.pop()
        if not ready:
            stack.append((node, True))
            stack += [(c, False) for c in node.children if isinstance(c, Node)]
            continue
        if node.dropped and id(node) not in suspects:
            sizes[id(node)] = (0, False)
            continue
        inner = [sizes[id(c)] for c in node.children if isinstance(c, Node)]
        size = sum(len("".join(c.split())) for c in node.children if isinstance(c, str)) + sum(n for n, _ in inner)
        sizes[id(node)] = size, node.tag in ("article", "main") or any(has for _, has in inner)
    for node in hinted:
        size, has_article = sizes[id(node)]
        node.dropped = not has_article and 2 * size < sizes[id(root)][0]


def parse(page: str) -> Node:
    """The element tree of a page, with implied ends of paragraphs, items and cells; stray end tags are ignored."""
    root = Node("#root")
    stack = [root]
    opened: Counter[str] = Counter()  # names on the stack, so that a stray end tag costs no look through it
    hinted: list[Node] = []
    raw: str | None = None

    def close(depth: int) -> None:
        for node in stack[depth:]:
            opened[node.tag] -= 1
        del stack[depth:]

    for match in _PIECES.finditer(page):
        piece = match[0]
        if raw is not None:
            if piece[:2] == "</" and piece[2 : 2 + len(raw)].lower() == raw:
                raw = None
                close(len(stack) - 1)
            continue
        if piece[0] != "<" or len(piece) == 1:
            stack[-1].children.append(entities.unescape(piece))
            continue
        named = _NAME.match(piece)
        if not named:  # comment, doctype, processing instruction
            continue
        tag = named[1].lower()
        if piece[1] == "/":
            if opened[tag]:
                close(next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth].tag == tag))
            continue
        if tag in CLOSES_P and opened["p"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in BLOCKS:
                    break
        if tag in SIBLINGS:
            ends, within = SIBLINGS[tag]
            for depth in range(len(stack) - 1, 0, -1) if any(opened[e] for e in ends) else ():
                if stack[depth].tag in within:
                    break
                if stack[depth].tag in ends:
                    close(depth)
                    break
        dropped, hint = _is_boilerplate(tag, piece, bool(opened["article"] or opened["main"]))
        node = Node(tag, dropped)
        if dropped and hint:
            hinted.append(node)
        stack[-1].children.append(node)
        if tag not in VOID and not piece.endswith("/>"):
            stack.append(node)
            opened[tag] += 1
            raw = tag if tag in RAW else None
    _keep_wrappers(root, hinted)
    return root


def hash_subtrees(root: Node) -> list[str]:
    """The page's lines (text between ends of blocks) in order; sets all elements' hashes, bottom up, and lines.

    Equal subtrees have equal hashes.  Dropped elements are no part of a subtree: a page's own script does not make its
    copy another page.
    """
    lines: list[list[str]] = []
    ended = True
    stack: list[tuple[Node | str, bool]] = [(root, False)]
    while stack:
        node, ready = stack.pop()
        if isinstance(node, str):
            if ended:
                lines.append([])
            lines[-1].append(node)
            ended = False
            continue
        ended = ended or node.tag in BLOCKS
        if not ready:
            node.first = len(lines)
            stack.append((node, True))
            for c in reversed(node.children):
                if isinstance(c, Node):
                    stack += [(c, False)] if not c.dropped else []
                elif text := " ".join(c.split()):
                    stack.append((text, False))
        else:
            node.stop = len(lines)
            content = [f"\x01{c.hash:x}" if isinstance(c, Node) else " ".join(c.split()) for c in node.children if isinstance(c, str) or not c.dropped]
            node.hash = xxhash.xxh64_intdigest("\x00".join([node.tag, *content])) - 2**63
            node.size = sum(c.size for c in node.children if isinstance(c, Node) and not c.dropped)
            node.size += sum(len(c) for c in content if c[:1] != "\x01")
    return [" ".join(line) for line in lines]


def recurring(root: Node) -> set[tuple[int | None, bool, bool, int]]:
    """(subtree, in an article, block of text, content) of a page's elements that may be template; null is the page.

    The content stands for the page (or article) around the subtree: its longest line outside the subtree.  So a page
    counts once, however many copies of it there are.
    """
    lines = hash_subtrees(root)
    articles = _articles(root)
    apart = {id(a) for a in articles}
    digests: dict[int, int] = {}
    found: set[tuple[int | None, bool, bool, int]] = set()
    for top, inside in [(root, False), *((a, True) for a in articles)]:
        longest = sorted(range(top.first, top.stop), key=lambda i: (-len(lines[i]), lines[i]))
        for i in longest[:1]:
            found.add((None, inside, False, xxhash.xxh64_intdigest(lines[i]) - 2**63))
        stack = [top]
        while stack:
            for node in stack.pop().children:
                if isinstance(node, str) or node.dropped or id(node) in apart:
                    continue
                stack.append(node)
                if node.tag in COUNTED and node.first < node.stop:
                    other = next((i for i in longest if not node.first <= i < node.stop), None)
                    if other is None:
                        continue
                    if other not in digests:
                        digests[other] = xxhash.xxh64_intdigest(lines[other]) - 2**63
                    found.add((node.hash, inside, node.tag in TEXT, digests[other]))
    return found


def main_text(root: Node, template: Container[int], boxes: Container[int] = ()) -> str:
    """Blocks of the article, white space inside a block as one space, joined by line ends.

    ``template`` holds the subtrees to delete of a page without article, ``boxes`` those inside articles.
    An element with half of the text of its page or article is never deleted.
    """
    roots = _articles(root) or [root]
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    # words in line go with their block
    recurs = template if roots == [root] else boxes
    for top in roots:
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                line.append(item)
            elif item.dropped or (
                item.tag in COUNTED and item.hash in recurs and 2 * item.size < top.size
            ):
                if item.tag in BLOCKS:
                    flush()
            else:
                ends = item.tag in BLOCKS
                if ends:
                    flush()
                    stack.append(None)
                stack += item.children[::-1]
        flush()
    return "\n".join(blocks)


def _articles(root: Node) -> list[Node]:
    """The outermost article elements that are not boilerplate (else main elements), in page order."""
    for wanted in ("article", "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.dropped:
                continue
            if node.tag == wanted:
                found.append(node)
            else:
                stack += [c for c in reversed(node.children) if isinstance(c, Node)]
        if found:
            return found
    return []


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def templates(pages: DataFrame, html: str, min_pages: int, min_share: float) -> DataFrame:
    """(host, inside, subtree): the hashes of each host that recur on enough of its distinct pages or articles.

    ``min_pages`` is the least number.  Outside articles a block of text needs ``min_share`` of the host's pages too and a
    box ``BOX_SHARE``, or ``MANY_PAGES``; inside they need ``ARTICLE_SHARE`` and ``ARTICLE_BOX_SHARE`` of its articles.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, html):
                seen: set = set()
                for host, page in zip(piece.column("__host").to_pylist(), piece.column(html).to_pylist()):
                    seen.update((host, *found) for found in recurring(parse(page or "")))
                columns = list(zip(*seen)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()))],
                    ["__host", "__subtree", "__inside", "text", "content"],
                )

    counted = (
        pages.select("__host", html).mapInArrow(run, "__host string, __subtree bigint, __inside boolean, text boolean, content bigint")
        .distinct().groupBy("__host", "__subtree", "__inside", "text").agg(F.count("*").alias("pages"))
        .where((F.col("pages") >= min_pages) | F.col("__subtree").isNull())
    )
    counted = staged(counted)
    sizes = counted.where("__subtree is null").select("__host", "__inside", F.col("pages").alias("all_pages"))
    share = F.when(
        F.col("__inside"), F.when(F.col("text"), ARTICLE_SHARE).otherwise(ARTICLE_BOX_SHARE)
    ).otherwise(F.when(F.col("text"), min_share).otherwise(BOX_SHARE))
    needed = F.col("all_pages") * share
    enough = F.col("pages") >= F.when(F.col("__inside"), needed).otherwise(F.least(needed, F.lit(MANY_PAGES)))
    return counted.where("__subtree is not null").join(sizes, ["__host", "__inside"]).where(enough).select("__host", "__inside", "__subtree")


def extract(
    pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE
) -> DataFrame:
    """All columns of ``pages`` but the html, with ``text`` and ``n_chars`` (own columns of these names are replaced)."""
    hosted = pages.drop("text", "n_chars").withColumn("__host", host_of(F.col(url)))
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    schema = widened(hosted.select(*kept).schema, text="string", n_chars="bigint")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, known = None, (set(), set())
        for batch in batches:
            for piece in slices(batch, html):
                texts, own = [], []
                columns = (piece.column(c).to_pylist() for c in ("__host", "__subtree", "__inside", html))
                for i, (of, subtree, inside, page) in enumerate(zip(*columns)):
                    if of != host:
                        host, known = of, (set(), set())
                    if subtree is not None:
                        known[inside].add(subtree)
                        continue
                    root = parse(page or "")
                    hash_subtrees(root)
                    texts.append(main_text(root, *known))
                    own.append(i)
                rows = piece.take(pa.array(own, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    schema.names,
                )

    # a host's template comes before its pages and is repeated, so that a large host's pages are dealt over several tasks
    large = staged(hosted.groupBy("__host").count().where(F.col("count") > PAGES_TOGETHER))
    large = large.select("__host", F.ceil(F.col("count") / PAGES_TOGETHER).alias("__salts"))
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    salted = hosted.select(*kept, html, "__host").join(large, "__host", "left").withColumn("__salt", F.pmod(F.xxhash64(url, html), salts)).drop("__salts")
    found = templates(hosted, html, min_pages, min_share).join(large, "__host", "left")
    found = found.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("__salts")
    dealt = salted.unionByName(found, allowMissingColumns=True).repartition("__host", "__salt")
    ordered = dealt.sortWithinPartitions("__host", "__salt", F.col("__subtree").isNull())
    return ordered.select(*kept, html, "__host", "__subtree", "__inside").mapInArrow(run, schema)
