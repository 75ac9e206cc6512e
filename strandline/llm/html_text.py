"""Main text of web pages by composite text density.

Sun, Song and Liao, "DOM based content extraction via text density", 2011.

A tolerant tokenizer builds the tag tree of the whole page (unclosed and stray
tags included) in time that is linear in the page. Inline elements belong to
the block around them. Every block counts the characters C and tags T below it
and the link characters LC and link tags LT among them. Its composite density is

    C / T * log_b(C / LC * T / LT),  b = ln(C / nLC * LC + body.LC / body.C * C + e)

where nLC = C - LC and zeros count as one. The densities of the blocks next below
add up to the density sum of a block; a block without blocks has its own. The
subtree with the largest sum holds the article; the smallest density on the path
from it to the body is the threshold. Starting at the body, blocks below the
threshold are dropped, and of each block that reaches it, at any depth, the one
with the largest density sum in its subtree is kept as content, whole.

Blocks that can't hold the article by their very meaning are not counted, however
much they hold: scripts, styles, forms, menus, headers and footers outside the
article, asides, reader comments, and elements whose class, id or role names an
advert, notice, menu or sidebar. A class or id counts as a whole ("sidebar", not
"has-sidebar"). Two things overrule such a name: a class, id or form around the
page's ``main`` or ``h1`` is a wrapper; and if next to no text is left without the
elements that a class or id names, the density decides which of them isn't one. A
paragraph or heading below the densest subtree, or in an article, stays whatever
its class.

Defined results: a null or empty html gives an empty text. A page without tags
is one block of text. Character references are decoded (cut ones as far as
HTML5 does); white space inside a block becomes one space; blocks are joined in
page order by one line feed. Of equal density sums the block that comes first,
and outermost, counts. Repeated rows each give a row; extra columns are ignored.
An empty table gives an empty result. Nothing is capped: memory follows the
longest page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import at_workers, read

#: A tag's attributes up to its end. Nothing is gone back over.
ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: Tags of a page whose quotes may be left open; after so many, a tag ends at the next >, whatever its quotes.
OPEN_QUOTES = 32
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg canvas title xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul xmp br".split()
)
DROPPED = frozenset("head nav aside footer form button select option dialog menu".split())
#: An open element of the first kind is closed by the opening of one of the second.
CLOSED_BY = {
    "p": BLOCKS - {"br"},
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]), "th": frozenset(["td", "th", "tr", "tbody"]),
}
#: What the opening of an element closes.
CLOSES = {name: frozenset(tag for tag, by in CLOSED_BY.items() if name in by) for name in frozenset().union(*CLOSED_BY.values())}
#: Elements past which an end tag or an implied end is not looked for.
SCOPE = frozenset("table td th ul ol dl article section div body html main aside nav header footer form blockquote".split())

#: A class name or id that says so as a whole: every part of it is one of these words, after the place at most.
WORD = r"(?:ads?|ad(?:box|slot|unit|wrapper|container|space)|advert\w*|adsense|banner|breadcrumbs?|comments?|comment-?list|consent|cookies?|disqus|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notification|pagination|pager|popup|promo\w*|recommend\w*|related|replies|responses|search|share|sharing|sidebar|signup|site-?header|skip|social|sponsor\w*|subscribe|tags|toolbar|widget)"
BOILERPLATE = re.compile(rf"(?:(?:site|page|main|primary|secondary|global)[-_]+)?{WORD}(?:[-_]+{WORD})*", re.I)
#: Whole class names or ids of the same meaning, outside an article.
OUTER = frozenset("header top topbar top-bar bottom copyright legal disclaimer".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())


#: How an element says that it isn't the article: by class or id (or as a form, which may be around a whole page), or by its kind.
SOFT, HARD = 1, 2
COMMENTS = re.compile(r"(?:(?:site|page|main|primary|secondary|global|user|reader)[-_]+)?(?:comments?|comment-?list|disqus|replies|responses)(?:[-_]+\w+)*", re.I)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Characters outside links that are next to no text.
LITTLE = 50


class Node:
    __slots__ = ("tag", "parent", "children", "named", "inside", "dropped", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, named: int = 0):
        self.tag, self.parent, self.named, self.dropped = tag, parent, named, False
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _boilerplate(tag: str, attributes: str, parent: Node) -> int:
    """Whether, and how, an element says of itself that it isn't the article."""
    if tag in DROPPED:
        return SOFT if tag == "form" else HARD
    if tag == "header":  # the article's own header holds its title
        return 0 if parent.inside else HARD
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0
    named = 0
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            if any(map(COMMENTS.fullmatch, value.split())) and tag not in PARAGRAPHS:
                return HARD
            if any(map(BOILERPLATE.fullmatch, value.split())) or not OUTER.isdisjoint(value.lower().split()) and not parent.inside:
                named = SOFT
        elif name == "role" and value.lower() in ROLES:
            return HARD
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return HARD
    return named


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("open", name, attributes), ("close", name, "") and ("raw", name, text) in page order.

    Every step goes on from where the one before ended; what can't be found once
    is not looked for again.
    """
    at, size, quotes = 0, len(page), 0
    gone: set[str] = set()  # raw elements without a further end tag
    text_from = 0
    while True:
        start = page.find("<", at)
        if start < 0 or start + 1 >= size:
            break
        c = page[start + 1]
        closing = c == "/"
        found = NAME.match(page, start + 1 + closing)
        if c == "!" or c == "?":
            if text_from < start:
                yield "text", "", page[text_from:start]
            mark = "-->" if page.startswith("<!--", start) else "]]>" if page.startswith("<![CDATA[", start) else ">"
            end = page.find(mark, start + (4 if mark == "-->" else 2))
            at = text_from = size if end < 0 else end + len(mark)
            continue
        if not found:
            at = start + 1
            continue
        whole = ATTRIBUTES.match(page, found.end()) if quotes < OPEN_QUOTES else None
        if whole is None:
            quotes += 1
            end = page.find(">", found.end())
            if end < 0:
                break  # no tag ends any more: the rest is text
            end += 1
        else:
            end = whole.end()
        if text_from < start:
            yield "text", "", page[text_from:start]
        at = text_from = end
        name, attributes = found.group().lower(), page[found.end() : end - 1]
        if closing:
            yield "close", name, ""
        elif name in RAW:  # up to its own end tag nothing is markup
            own = None if name in gone else re.compile(rf"</{re.escape(name)}\s*+>", re.I).search(page, at)
            if own is None:
                gone.add(name)
            if name in ("script", "style", "xmp") or not attributes.rstrip().endswith("/"):
                stop = own.start() if own else size if name in ("script", "style", "xmp") else at
                yield "raw", name, page[at:stop]
                at = text_from = own.end() if own else stop
        else:
            yield "open", name, attributes
    if text_from < size:
        yield "text", "", page[text_from:]


def tree(page: str) -> Node:
    """The tag tree below a root node; text as strings among the children.

    For each element of SCOPE that is open, what is open since is counted by
    name, so that looking for something to close costs nothing if there is none.
    """
    root = node = Node("#root", None)
    since: list[Counter] = [Counter()]  # open elements by name since the root and since every open element of SCOPE
    scopes: Counter = Counter()

    def leave() -> None:
        nonlocal node
        if node.tag in SCOPE:
            since.pop()
            scopes[node.tag] -= 1
        else:
            since[-1][node.tag] -= 1
        node = node.parent

    for kind, name, text in tokens(page):
        if kind == "text":
            node.children.append(text)
        elif kind == "raw":
            if name == "xmp":  # of these only xmp shows its text
                shown = Node(name, node)
                shown.children.append(html.escape(text, quote=False))
                node.children.append(shown)
        elif kind == "close":
            if (scopes if name in SCOPE else since[-1])[name]:
                while node.tag != name:
                    leave()
                leave()
            elif name == "p":
                node.children.append(Node("br", node))
        else:
            closed = [x for x in CLOSES.get(name, ()) if x not in SCOPE and since[-1][x]]
            if closed:
                while node.tag not in closed:
                    leave()
                leave()
            elif node.tag in ("td", "th") and name in CLOSED_BY[node.tag]:
                leave()
            own = Node(name, node, _boilerplate(name, text, node))
            node.children.append(own)
            if name not in VOID and not text.rstrip().endswith("/"):
                node = own
                if name in SCOPE:
                    since.append(Counter())
                    scopes[name] += 1
                else:
                    since[-1][name] += 1
    return root


def _weigh(root: Node) -> tuple[Node, list[Node]]:
    """Fill in counts, densities and sums; returns the body and its blocks, each before those below it."""
    order, body, stack = [], None, [root]
    while stack:
        node = stack.pop()
        order.append(node)
        if body is None and node.tag == "body":
            body = node
        stack += [x for x in reversed(node.children) if not isinstance(x, str) and not x.dropped]
    body = body or root
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for x in node.children:
            if isinstance(x, str):
                node.chars += len(" ".join(x.split()))
            elif not x.dropped:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    ratio = body.link_chars / max(body.chars, 1)
    for node in order:
        c, t, lc, lt = max(node.chars, 1), max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c / max(node.chars - node.link_chars, 1) * node.link_chars + ratio * node.chars + math.e)
        node.density = node.chars / t * max(math.log(c / lc * t / lt), 0.0) / base if node.chars else 0.0
        node.total = 0.0
    for node in reversed(order):
        block = node is body or node is root or node.tag in BLOCKS
        if block and not node.total:
            node.total = node.density
        if node.parent is not None:  # an inline element hands on what the blocks in it add up to
            node.parent.total += node.density if block else node.total
    inside, stack = [], [body]
    while stack:
        node = stack.pop()
        if node is body or node.tag in BLOCKS:
            inside.append(node)
        stack += [x for x in reversed(node.children) if not isinstance(x, str) and not x.dropped]
    return body, inside


def _above(node: Node, body: Node) -> Iterator[Node]:
    """The node and what is around it, up to the body."""
    while node is not None:
        yield node
        if node is body:
            return
        node = node.parent


def _around(node: Node) -> Node | None:
    """The block next around a node."""
    up = node.parent
    while up is not None and up.parent is not None and up.tag not in BLOCKS:
        up = up.parent
    return up


def _densest(inside: list[Node]) -> Node:
    """The block of the largest sum; of equal ones that hold nothing else, the innermost."""
    top = max(inside, key=lambda x: x.total)
    for node in inside:
        if node.total == top.total and _around(node) is top:
            top = node
    return top


def main_nodes(root: Node) -> list[Node]:
    """The content nodes in page order, none below another."""
    every, stack = [], [root]
    while stack:
        node = stack.pop()
        every.append(node)
        stack += [x for x in node.children if not isinstance(x, str)]
    wrappers: set[Node] = set()  # what is around the page's main element or heading
    for node in every:
        if node.tag == "main" or node.tag == "h1":
            while node is not None and node not in wrappers:
                wrappers.add(node)
                node = node.parent
        elif node.tag == "body":  # an unclosed head is around it
            for up in _above(node, root):
                up.named = 0
    for node in every:
        node.dropped = bool(node.named) and not (node.named == SOFT and node in wrappers)
    body, inside = _weigh(root)
    if body.chars - body.link_chars >= LITTLE:
        top = _densest(inside)
    else:
        for node in every:
            node.dropped = node.named == HARD
        body, inside = _weigh(root)
        top = _densest(inside)
        decided = {*_above(top, root)}
        for node in every:
            node.dropped = node.dropped or node.named == SOFT and node not in decided and node not in wrappers
        body, inside = _weigh(root)
    kept = [x for x in every if x.dropped and x.named == SOFT and x.tag in PARAGRAPHS and (x.inside or any(y is top for y in _above(x, root)))]
    if kept:
        for node in kept:
            node.dropped = False
        body, inside = _weigh(root)
    if not body.chars:
        return []
    # the block of the largest sum in each subtree, the first of equal ones
    best = {node: node for node in inside}
    for node in reversed(inside):
        up = _around(node)
        if node is not body and best[node].total >= best[up].total and (best[up] is not up or best[node].total > up.total):
            best[up] = best[node]
    threshold = min(x.density for x in _above(best[body], body) if x in best)
    chosen, low = set(), {}
    for node in inside:
        low[node] = node is not body and low[_around(node)] or node.density < threshold or not node.chars
        if not low[node]:
            chosen.add(best[node])
    found, stack = [], [body]
    while stack:
        node = stack.pop()
        if node in chosen:
            found.append(node)
        else:
            stack += [x for x in reversed(node.children) if not isinstance(x, str) and not x.dropped]
    return found


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below ``node`` in page order, references decoded, white space folded."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                out.append(text)

    stack: list[Node | str | None] = [node]
    while stack:
        x = stack.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            run.append(x)
        elif not x.dropped:
            if x.tag in BLOCKS:
                close()
                stack.append(None)
            stack += reversed(x.children)
    close()
    return out


def extract(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(t for node in main_nodes(tree(page)) for t in blocks(node))


def _texts(columns: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in columns:
        texts = [extract(x.as_py()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    at_workers(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_texts, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))
