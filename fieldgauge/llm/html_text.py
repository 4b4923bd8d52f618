"""Main text of web pages by tree scoring.

The page becomes a tree. Parts that never hold the article (menus, page headers and footers,
asides, hidden parts, scripts) are cut. Forms, and elements named like a sidebar, notice, advert
or comment, are cut too, unless they hold most of the page's paragraph points. Each paragraph
gives points for length and commas to its ancestors, fewer the farther they are; a container's
points are discounted by the share of its text that is links. The article or main element around
the best container is kept; where there is none, the best container and, at every level around
it, whatever holds paragraphs and is not mostly links.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg canvas title textarea select noframes audio video".split())
#: Of these, the ones that last to the end of the page where their end tag is missing.
UNENDED = frozenset("script style title textarea".split())
CUT = frozenset("nav footer aside button dialog menu head annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH_ENDS = BLOCK - frozenset("td th tr tbody thead tfoot li dd dt body html".split())
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
}
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
CUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs byline comment comments commentlist cookie cookies consent"
    " disqus foot footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup"
    " promo promotion recommended related replies respond share sharebar sharing sidebar skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Of these, the ones that a discussion below the article is named by: it may be longer than the article.
DISCUSSION = frozenset("comment comments commentlist disqus replies respond".split())
NEVER_NAMED = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
WRAPPERS = frozenset("has with no is without".split())
#: Siblings of these kinds belong to the article even without points, unless a quarter of their text is links.
CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|([^>]*)(?:>|\Z))", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PARTS = re.compile(r"[^a-z0-9]+")
#: A named element that holds most of the points is cut all the same if the page has its article elsewhere: so much of
#: the points in another article or main element, or, for a discussion, in the rest of the page.
ELSEWHERE_SHARE = 0.2
FULL_LENGTH, LENGTH_POINTS = 100, 3
#: Ancestors a paragraph gives points to; the next would get about a hundredth of them.
REACH = 32


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "names", "points", "own", "mass", "chars", "linked", "commas")

    def __init__(self, tag: str, parent: Node | None, cut: bool, names: frozenset[tuple[str, str]] = frozenset()) -> None:
        self.tag, self.parent, self.cut, self.names = tag, parent, cut, names
        self.parts: list[Node | str] = []
        self.points, self.own, self.mass, self.chars, self.linked = 0.0, 0.0, 0.0, 0, 0
        self.commas = 0


def _marks(tag: str, written: str, parent: Node) -> tuple[bool, frozenset[tuple[str, str]]]:
    """Whether an element is one of those that never hold the article, and the names, each with
    the first part of its word, that speak against it. A page may wrap its text in a form."""
    names: set[tuple[str, str]] = {("form", "form")} if tag == "form" else set()
    if tag in CUT or tag in RAW or (tag == "label" and parent.tag not in PARAGRAPHS):
        return True, frozenset()
    in_article = _inside(parent, ("article", "main")) if tag == "header" or "header" in written.lower() else False
    if tag == "header" and not in_article:
        return True, frozenset()
    if not written or tag in ("html", "body"):
        return False, frozenset(names)
    for name, value in ATTRIBUTE.findall(written):
        name, value = name.lower(), html.unescape(value.strip("\"'")).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in CUT_ROLES):
            return True, frozenset()
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, frozenset()
        if name == "role" and value == "form":
            names.add(("form", "form"))
        if name in ("class", "id") and tag not in NEVER_NAMED:
            for word in value.split():
                parts = [p for p in NAME_PARTS.split(word) if p]
                # of a paragraph only a word made of such names alone tells: "notice", not "notice-period"
                if parts and parts[0] not in WRAPPERS and not (tag in PARAGRAPHS and not CUT_NAMES.issuperset(parts)):
                    # an article has a header of its own
                    names.update((parts[0], p) for p in CUT_NAMES.intersection(parts) if p != "header" or not in_article)
    return False, frozenset(names)


def _inside(node: Node | None, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def parse(page: str) -> Node:
    """A tree of the elements that are not cut; unclosed and misnested tags are tolerated."""
    root = Node("#root", None, False)
    at, here = 0, root
    unclosed: Counter[str] = Counter()
    endless: set[str] = set()

    def up_to(node: Node) -> Node:
        left = here
        while left is not node:
            unclosed[left.tag] -= 1
            left = left.parent
        return node

    while True:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            here.parts.append(html.unescape(text))
        if not m:
            return root
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if unclosed[tag]:
                here = up_to(_close(here, tag))
            continue
        written = m[3] if m[3] is not None else m[4] or ""
        if tag in RAW:
            if not written.endswith("/") and tag not in endless:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
                if end:
                    at = end.end()
                elif tag in UNENDED:
                    at = len(page)
                else:
                    endless.add(tag)
            continue
        if tag in VOID:
            here.parts.append(Node(tag, here, False) if tag == "hr" else " ")
            continue
        if unclosed["p"] or tag in CLOSES:
            here = up_to(_imply_end(here, tag))
        node = Node(tag, here, *_marks(tag, written, here))
        here.parts.append(node)
        if not (written.endswith("/") and tag not in BLOCK):
            here = node
            unclosed[tag] += 1


def _close(here: Node, tag: str) -> Node:
    node = here
    while node is not None and node.tag != tag:
        if node.tag in ("article", "main", "body", "td") and tag not in BLOCK:
            return here  # a stray inline end tag closes nothing beyond its block
        node = node.parent
    return node.parent if node is not None and node.parent is not None else here


def _imply_end(here: Node, tag: str) -> Node:
    if tag in PARAGRAPH_ENDS:
        node = here
        while node is not None and node.tag not in ("p", "td", "th", "li", "table", "button"):
            if node.tag in BLOCK:
                break
            node = node.parent
        if node is not None and node.tag == "p":
            here = node.parent
    if tag in CLOSES:
        ended, bounds = CLOSES[tag]
        node, last = here, None
        while node is not None and node.tag not in bounds:
            if node.tag in ended.split():
                last = node
            node = node.parent
        if last is not None and node is not None:
            here = last.parent
    return here


def _walk(root: Node) -> Iterator[Node]:
    """Uncut nodes, parents first; without recursion, as pages may nest deeply."""
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.cut)


def _measure(nodes: list[Node]) -> None:
    """Characters, those in links, and the paragraph points of every node, its own and in all (mass)."""
    for node in reversed(nodes):  # children before parents
        own = sum(len(p.split()) and len(" ".join(p.split())) for p in node.parts if isinstance(p, str))
        kids = [p for p in node.parts if isinstance(p, Node) and not p.cut]
        node.chars = own + sum(k.chars for k in kids)
        commas = sum(p.count(",") + p.count("،") + p.count("，") for p in node.parts if isinstance(p, str))
        node.commas = commas + sum(k.commas for k in kids)
        node.linked = node.chars if node.tag == "a" else sum(k.linked for k in kids)
        node.own = _paragraph_points(node)
        node.mass = node.own + sum(k.mass for k in kids)


def _paragraph_points(node: Node) -> float:
    """Points of a node as a paragraph; 0 for what is none, or all links."""
    direct = "".join(p for p in node.parts if isinstance(p, str)).strip()
    if not node.chars or not (node.tag in PARAGRAPHS or (direct and node.tag in BLOCK and not re.fullmatch(r"h[1-6]", node.tag))):
        return 0.0
    if any(isinstance(p, Node) and p.tag in PARAGRAPHS for p in node.parts) and not direct:
        return 0.0
    points = 1 + node.commas + min(node.chars / FULL_LENGTH, LENGTH_POINTS)
    return points * (1 - node.linked / node.chars)


def _cut_named(root: Node) -> None:
    """Cut the named elements, except those that hold most of the page's paragraph points alone,
    or together with the others named alike."""
    nodes = list(_walk(root))
    named = [n for n in nodes if n.names]
    if not named:
        return
    _measure(nodes)
    size = (lambda n: n.mass) if root.mass else (lambda n: float(n.chars))  # a page of headings has no points
    articles = [n for n in nodes if n.tag in ("article", "main")]

    def outermost(some: list[Node]) -> list[Node]:
        inside = set(map(id, some))
        return [n for n in some if not _among(n.parent, inside)]

    def released(tops: list[Node], name: str) -> bool:
        held = sum(map(size, tops))
        if 2 * held <= size(root):
            return False
        if name in DISCUSSION:
            return size(root) - held < ELSEWHERE_SHARE * size(root)
        if not articles:
            return True
        around: set[int] = set()
        for n in tops:
            node: Node | None = n
            while node is not None and id(node) not in around:
                around.add(id(node))
                node = node.parent
        within = set(map(id, tops))
        elsewhere = outermost([a for a in articles if id(a) not in around and not _among(a, within)])
        return sum(map(size, elsewhere)) < ELSEWHERE_SHARE * size(root)

    doubtful = [n for n in named if not all(released([n], name) for _, name in n.names)]
    groups: dict[tuple[str, str], list[Node]] = {}
    for n in doubtful:
        for key in n.names:
            groups.setdefault(key, []).append(n)
    spared = {key for key, some in groups.items() if released(outermost(some), key[1])}
    for n in doubtful:
        n.cut = not n.names <= spared


def _among(node: Node | None, ids: set[int]) -> bool:
    while node is not None:
        if id(node) in ids:
            return True
        node = node.parent
    return False


def _score(root: Node) -> None:
    nodes = list(_walk(root))
    _measure(nodes)
    for node in nodes:
        ancestor, distance = (node.parent if node.tag in PARAGRAPHS else node), 0
        while node.own and ancestor is not None and ancestor.tag != "#root" and distance <= REACH:
            ancestor.points += node.own / (1 if distance == 0 else 2 if distance == 1 else 3 * distance)
            ancestor, distance = ancestor.parent, distance + 1


def _rating(node: Node) -> float:
    return node.points * (1 - node.linked / node.chars) if node.chars else 0.0


def _blocks(roots: list[Node | str]) -> list[str]:
    """Texts of blocks in page order; inline elements do not break a block."""
    blocks: list[str] = []
    current: list[str] = []

    def flush() -> None:
        text = " ".join("".join(current).split())
        if text:
            blocks.append(text)
        current.clear()

    todo: list[Node | str | None] = list(reversed(roots))
    while todo:
        part = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            current.append(part)
        elif not part.cut:
            breaks = part.tag in BLOCK
            if breaks:
                flush()
                todo.append(None)
            todo.extend(reversed(part.parts))
    flush()
    return blocks


def main_text(page: str | None) -> str:
    """Blocks of the article joined by line breaks; empty where there is none."""
    if not page:
        return ""
    root = parse(page)
    _cut_named(root)
    _score(root)
    rated = [(n, _rating(n)) for n in _walk(root) if n.points]
    if not rated:
        containers = [n for n in _walk(root) if n.tag in ("article", "main")] or [root]
        return "\n".join(_blocks(containers[:1]))
    best, rating = max(rated, key=lambda x: x[1])
    top = best
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            top = node
            if node.tag == "article":
                break
        node = node.parent
    kept: list[Node | str] = [top]
    if top.tag == "article" and top.parent is not None:  # one text may be told in several articles, side by side
        kept = [p for p in top.parent.parts if p is top or (isinstance(p, Node) and p.tag == "article" and not p.cut and p.mass and p.linked * 4 <= p.chars)]
    while top.parent is not None and top.tag not in ("article", "main", "body", "html"):
        kept, top = _belonging(top.parent.parts, top, kept), top.parent
    return "\n".join(_blocks(kept))


def _belonging(siblings: list[Node | str], top: Node, kept: list[Node | str]) -> list[Node | str]:
    """What is kept of the best container, or of an element around it, and those siblings that
    are part of the article: they hold paragraphs, or are content by their kind or text outside
    blocks, and are not mostly links."""
    found: list[Node | str] = []
    run: list[Node | str] = []

    def end_run() -> None:
        chars = sum(len(p.strip()) if isinstance(p, str) else p.chars for p in run)
        if chars and 4 * sum(p.linked for p in run if isinstance(p, Node)) <= chars:
            found.extend(run)
        run.clear()

    for p in siblings:
        if p is not top and (isinstance(p, str) or p.tag not in BLOCK):
            if isinstance(p, str) or not p.cut:
                run.append(p)
            continue
        end_run()
        if p is top:
            found.extend(kept)
        elif not p.cut and p.chars and p.linked * 4 <= p.chars and (p.tag in CONTENT or p.mass):
            found.append(p)
    end_run()
    return found


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page, from the whole html.

    A NULL or empty page, and one without text, gives an empty text; NULL ids and repeated rows
    are kept; other columns are ignored. White space inside a block becomes one blank.
    """
    source = pages.select("page_id", "url", "html")
    schema = StructType([source.schema["page_id"], source.schema["url"], StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return source.mapInArrow(run, schema)
