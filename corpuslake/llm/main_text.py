"""Main text of web pages by tree scoring.

Blocks of text pass points for their length and commas to their ancestors, the whole
to the nearest, less to the next; an element's points are discounted by its share of
linked text.  The best element (or the article around it) is kept with those siblings
that are no lists of links; on pages that mark no article, with everything of little
linked text in the container around it.  Menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments are cut out of the tree first, by tag
or by a word of their names; but never what the article itself stands in, whatever it is
called, and a form around the page only loses its controls.  Names such as "has-sidebar"
or "no-ads" say nothing of the part.  Time is linear in the page, unclosed elements included.
"""

import re
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed by HTML: elements without content, with raw content, and that never hold text of a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_CUT = frozenset(
    "head nav footer aside noscript template iframe object svg math select button dialog audio video canvas".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag of the key ends an open element of the values, up to the bounds.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
# Words in a class, id or role that tell parts of a page that are not its article.
_FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar sidenav menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead topbar toolbar share sharing social comment comments disqus "
    "replies respond related recommended recommendations widget widgets pagination pager login signup search "
    "contentinfo complementary alert".split()
)
# Words that only say how a part is laid out, not what it holds ("comment-list" is still comments).
_NEUTRAL = frozenset(
    "area bar bottom box button buttons center column container content footer fixed form group header holder icon "
    "icons inner item items label left link links list main mobile outer panel pane post posts primary region right "
    "secondary section slot small sticky text title toggle top unit wrap wrapper zone "
    "x div js id block bg sm md lg xl".split()
)
# A name that begins so tells what a page has or has not around its article.
_STATE = frozenset("with without has have no not non is hide hides hidden show shows".split())
_OWN = frozenset("article body content entry main post story text page".split())
_NEVER_CUT = frozenset("html body main article".split())
_HEADER = frozenset({"header"})
# What may go on with the text of an article that stands in the body of the page.
_SIBLINGS = frozenset("p section article main blockquote pre table ul ol dl figure div".split())
_LEVELS = 24  # ancestors that a block passes points to
_BASE = {"article": 10, "main": 8, "section": 4, "div": 5, "td": 3, "blockquote": 3, "pre": 3}

_MARK = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"""
    r"""|<[!?/][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z""",
    re.S,
)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_TOKEN = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


class _Node:
    """``foreign`` is 2 where name or tag say the part is none of the article, 1 where a compound name may mean else."""

    __slots__ = (
        "tag", "parent", "names", "cut", "foreign", "gone", "heading_only", "linking", "heading", "article",
        "points", "chars", "linked", "links", "kept", "listed",
    )

    def __init__(self, tag, parent, names):
        self.tag, self.parent, self.names = tag, parent, names
        self.cut = parent.cut if parent else False
        self.heading_only = parent.heading_only if parent else False
        self.linking = tag == "a" or (parent.linking if parent else False)
        self.heading = tag in _HEADINGS or (parent.heading if parent else False)
        self.article = tag == "article" or (parent.article if parent else False)
        self.foreign, self.gone = 0, False
        self.points, self.chars, self.linked, self.links, self.kept, self.listed = 0.0, 0, 0, 0, False, False

    def inside(self, tags):
        node = self
        while node:
            if node.tag in tags:
                return node
            node = node.parent
        return None


@lru_cache(maxsize=4096)
def _names(attributes: str):
    """``(all words, strangeness as a header, strangeness as a foreign part)`` of class, id and role."""
    if "=" not in attributes:
        return frozenset(), 0, 0
    found = [name for m in _NAMED.finditer(attributes) for name in m[2].strip("\"'").split()]
    parts = [[t.lower() for t in _TOKEN.findall(name)] for name in found]
    parts = [words for words in parts if words and words[0] not in _STATE]
    words = frozenset(w for words in parts for w in words)
    return words, _strangeness(parts, _HEADER), _strangeness(parts, _FOREIGN)


def _strangeness(parts, strange) -> int:
    """2 if a name is of the strange words, alone, as its last word or among neutral ones; 1 if it only holds one."""
    most = 0
    for words in parts:
        if any(w in strange for w in words):
            plain = words[-1] in strange or all(w in strange or w in _NEUTRAL for w in words)
            most = max(most, 2 if plain else 1)
    return most


class _Page:
    """Tree of a page and its blocks ``[owner, text, linked characters]`` in page order.

    Stack positions of the open elements are kept by tag, so that no unclosed element is
    walked over twice.
    """

    def __init__(self, html: str):
        self.nodes, self.runs = [], []
        self.parts = []
        self.stack, self.at, self.block_at = [], {}, []
        self._push(self._node("html", None, frozenset()))
        self.read(html)
        self.resolve()
        self.blocks = list(self._blocks())

    def _node(self, tag, parent, names):
        node = _Node(tag, parent, names)
        self.nodes.append(node)
        return node

    def _push(self, node):
        self.at.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in _BLOCK:
            self.block_at.append(len(self.stack))
        self.stack.append(node)

    def _cut_to(self, size):
        while len(self.stack) > size:
            node = self.stack.pop()
            self.at[node.tag].pop()
            if node.tag in _BLOCK:
                self.block_at.pop()

    def _last(self, *tags) -> int:
        """Stack position of the innermost open element of these tags, -1 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def flush(self):
        if self.parts:
            self.runs.append((self.stack[self.block_at[-1]], self.parts))
            self.parts = []

    def text(self, raw):
        top = self.stack[-1]
        if top.cut or (top.heading_only and not top.heading):
            return
        self.parts.append((top, unescape(raw) if "&" in raw else raw))

    def _blocks(self):
        for owner, parts in self.runs:
            kept = [(node, value) for node, value in parts if not node.gone]
            text = " ".join("".join(value for _, value in kept).split())
            if text:
                linked = sum(len(value.strip()) for node, value in kept if node.linking)
                yield owner, text, min(linked, len(text))

    def open(self, tag, attributes):
        if tag == "br":
            self.parts.append((self.stack[-1], " "))
            return
        if tag in ("html", "body") and self.at.get(tag):
            return
        if tag in _BLOCK:
            self.flush()
            self.end_paragraph()
        if tag in _ENDS:
            ended, bounds = _ENDS[tag]
            found = self._last(*ended)
            if found > max(self._last(*bounds), 0):
                self.flush()
                self._cut_to(found)
        if tag in _VOID:
            return
        if tag == "body" and self.at.get("head"):
            self._cut_to(1)
        words, as_header, as_foreign = _names(attributes)
        node = self._node(tag, self.stack[-1], words)
        if tag not in _NEVER_CUT:
            head = 2 if tag == "header" else as_header if tag in _BLOCK and tag not in _HEADINGS else 0
            if head and node.parent.article:
                node.heading_only = True
            elif head:
                node.foreign = head
            elif tag in _CUT:
                node.cut = True
            else:
                node.foreign = 1 if tag == "form" else as_foreign
        elif tag == "article" and node.names & {"comment", "comments", "related", "ad", "advert", "sponsored"}:
            node.cut = True
        if tag == "a" and node.parent:
            node.parent.links += 1
        self._push(node)

    def end_paragraph(self):
        if self.block_at and self.stack[self.block_at[-1]].tag == "p":
            self._cut_to(self.block_at[-1])

    def close(self, tag):
        found = self._last(tag)
        if found < 1:
            return
        blocks_inside = self.block_at and self.block_at[-1] >= found
        if blocks_inside and tag not in _BLOCK:
            return  # an inline end tag does not close blocks
        if blocks_inside:
            self.flush()
        self._cut_to(found)

    def read(self, html):
        at, size = 0, len(html)
        while at < size:
            m = _MARK.search(html, at)
            if m is None:
                self.text(html[at:])
                break
            if m.start() > at:
                self.text(html[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self.close(tag)
            elif tag in _RAW:
                end = re.compile(rf"</{tag}(?![^\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else size
            else:
                attributes = m[3] if m[2] else m[6]
                self.open(tag, attributes)
                if attributes.endswith("/") and tag in ("svg", "math"):
                    self.close(tag)
        self.flush()

    def resolve(self):
        """Decides which foreign parts go: none that the article itself stands in.

        If all articles stand in foreign parts, the one with most running text stays with
        what it stands in, if it has more than the page has elsewhere.  On a page without
        one, parts of doubtful names and forms stay where they hold most of the text.
        """
        running = {}
        for _, parts in self.runs:
            for node, value in parts:
                if not node.linking:
                    running[node] = running.get(node, 0) + len(value.strip())
        amount = [0, 0, 0]  # running text by strangeness
        strange = {}  # the greatest strangeness of a node and what it stands in
        below, doubtful = {}, {}  # running text of a node and of what stands in it; that without foreign parts
        for node in self.nodes:
            strange[node] = max(node.foreign, strange[node.parent] if node.parent else 0)
            below[node] = running.get(node, 0)
            amount[strange[node]] += below[node]
            doubtful[node] = below[node] if strange[node] < 2 else 0
        for node in reversed(self.nodes):
            if node.parent:
                below[node.parent] += below[node]
                doubtful[node.parent] += doubtful[node]
        articles = [n for n in self.nodes if n.tag in ("article", "main") and not n.cut and below[n]]
        if articles and all(strange[n] for n in articles):
            best = max(articles, key=below.get)
            if below[best] > amount[0]:
                node = best
                while node:
                    node.foreign = 0
                    node = node.parent
        elif not articles and amount[0] < amount[1]:
            for node in self.nodes:
                if node.foreign == 1 and 2 * doubtful[node] > amount[1]:
                    node.foreign = 0
        for node in self.nodes:
            # A doubtful name within an article means something else if it holds most of it.
            around = node.parent and node.parent.inside(("article",)) if node.foreign == 1 and node.article else None
            if around and 2 * below[node] > below[around]:
                node.foreign = 0
            node.gone = node.foreign > 0 or (node.parent.gone if node.parent else False)

    def score(self):
        for owner, text, linked in self.blocks:
            points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
            owner.chars += len(text)
            owner.linked += linked
            node, level = (owner.parent if owner.tag == "p" or owner.tag in _HEADINGS or owner.tag == "li" else owner), 0
            while node and level < _LEVELS:
                node.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                node, level = node.parent, level + 1
        for node in reversed(self.nodes):  # children come after their parents
            if node.parent:
                node.parent.chars += node.chars
                node.parent.linked += node.linked
                node.parent.links += node.links
        for node in self.nodes:
            node.listed = self.menu(node) or (node.parent.listed if node.parent else False)

    def worth(self, node):
        if not node.chars:
            return 0.0
        own = node.points + _BASE.get(node.tag, 0) + (25 if node.names & _OWN else 0)
        return own * (1 - node.linked / node.chars)

    def menu(self, node):
        """A list of links."""
        return node.tag in ("ul", "ol", "menu", "dl") and node.links >= 3 and node.linked >= 0.7 * node.chars

    def main_blocks(self) -> list[str]:
        self.score()
        open_nodes = [n for n in self.nodes if n.chars and n.tag in _BLOCK and n.tag != "p" and n.tag not in _HEADINGS]
        if not open_nodes:
            return []
        best = max(open_nodes, key=self.worth)
        top = best.inside(("article",)) or best.inside(("main",)) or best
        top.kept = True
        if top.tag not in ("article", "main"):
            return self._around(top)
        for node in self.nodes:
            if node.parent is top.parent and node is not top and node.chars:
                if node.tag in _HEADINGS:
                    node.kept = top.tag != "article"
                elif top.parent.tag not in ("html", "body") or node.tag in _SIBLINGS:
                    node.kept = node.linked / node.chars < 0.25
        self._spread()
        return [text for owner, text, _ in self.blocks if owner.kept]

    def _spread(self):
        """What stands in a kept element is kept."""
        for node in self.nodes:
            node.kept = node.kept or bool(node.parent and node.parent.kept)

    def _around(self, top) -> list[str]:
        """Blocks of ``top`` and what has few links in the container that it shares with other text."""
        while top.parent and top.parent.chars == top.chars:
            top = top.parent
            top.kept = True
        for node in self.nodes:
            if node.parent is top.parent and node.chars and (node.tag in _HEADINGS or node.linked / node.chars < 0.25):
                node.kept = True
        self._spread()
        below = set()
        for node in self.nodes:
            if node is top.parent or node.parent in below:
                below.add(node)
        found, begun = [], False
        for owner, text, linked in self.blocks:
            few = linked / len(text) < 0.25
            # Lists of links beside the text belong to it, but not those straight in the body of the page.
            fits = few or (owner.listed and top.parent and top.parent.tag not in ("html", "body"))
            inside = owner.kept or (fits and owner in below)
            # Where no article is marked, a list of links before its first text is a menu.
            if inside and (begun or not owner.listed):
                found.append(text)
                begun = begun or few
        return found


def main_text(html: str | None) -> str:
    """Blocks of the main text, two line ends between them; empty if there is none."""
    return "\n\n".join(_Page(html).main_blocks()) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``; null html counts as empty, other columns are not read."""

    def run(batches):
        for batch in batches:
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(pages.dtypes)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
