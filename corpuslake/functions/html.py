"""Title and body text of HTML pages as an Arrow function.

Tolerant parsing (stdlib ``html.parser``): an end tag closes everything opened
since its start tag and is ignored when no such tag is open.
"""

import re
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslake import constants as C

_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
_SILENT = frozenset(("script", "style", "template", "rp", "rt"))
_VERBATIM = frozenset(("pre", "textarea"))
_SPACES = re.compile(r"\s+")
_SELECTOR = re.compile(r"^(?P<tag>[a-zA-Z][\w-]*)(?:(?P<kind>[.#])(?P<name>.+))?$")


def compile_selector(selector: str):
    """``tag``, ``tag.class`` or ``tag#id`` as (tag, kind, name)."""
    found = _SELECTOR.match(selector)
    if not found:
        raise ValueError(f"selector must be tag, tag.class or tag#id, got {selector!r}")
    return found["tag"].lower(), found["kind"], found["name"]


def _selects(selector, tag, attrs):
    wanted, kind, name = selector
    if tag != wanted:
        return False
    if kind == "#":
        return attrs.get("id") == name
    if kind == ".":
        value = attrs.get("class") or ""
        return name == value or name in value.split()
    return True


class _Finished(Exception):
    pass


class _FirstMatches(HTMLParser):
    """Text of the first element that each selector finds."""

    def __init__(self, groups):
        super().__init__(convert_charrefs=False)
        self.best = [group[0] for group in groups]
        self.pending = [s for group in groups for s in group]
        self.tags = {s[0] for s in self.pending}
        self.text = {}
        self.active = []  # (depth, selector)
        self.stack = []
        self.open = {}
        self.node = []

    def _flush(self):
        if not self.node:
            return
        data, self.node = "".join(self.node), []
        if any(self.open.get(tag) for tag in _SILENT):
            return
        if not data.strip(" \t\n\r\f") and not any(self.open.get(t) for t in _VERBATIM):
            data = "\n" if "\n" in data else " "
        for _, selector in self.active:
            self.text[selector].append(data)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in self.tags and self.pending:
            named = dict(attrs)
            for selector in [s for s in self.pending if _selects(s, tag, named)]:
                self.pending.remove(selector)
                self.text[selector] = []
                self.active.append((len(self.stack), selector))
        self.stack.append(tag)
        self.open[tag] = self.open.get(tag, 0) + 1
        if tag in _VOID:
            self.handle_endtag(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        if not self.open.get(tag):
            return
        while True:
            top = self.stack.pop()
            self.open[top] -= 1
            if top == tag:
                break
        if self.active:
            depth = len(self.stack)
            self.active = [a for a in self.active if a[0] < depth]
            if not self.active and all(s in self.text for s in self.best):
                raise _Finished

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_data(self, data):
        if self.active:
            self.node.append(data)

    def handle_entityref(self, name):
        self.handle_data(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[:1] in "xX" else int(name)
            if code < 256:
                self.handle_data(bytes((code,)).decode("windows-1252", "ignore") or chr(code))
            else:
                self.handle_data(chr(code))
        except (ValueError, OverflowError):
            self.handle_data("�")

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self.handle_data(data[6:])
            self._flush()

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = handle_comment


def page_text(html, titles, bodies):
    """(title, content) of one page; selectors come compiled."""
    if not html:
        return C.TITLE_PLACEHOLDER, C.BODY_PLACEHOLDER
    parser = _FirstMatches((titles, bodies))
    try:
        parser.feed(html)
        parser.close()
        parser._flush()
    except _Finished:
        pass
    title = next((parser.text[s] for s in titles if s in parser.text), None)
    body = next((parser.text[s] for s in bodies if s in parser.text), None)
    title = C.TITLE_PLACEHOLDER if title is None else "".join(title).strip()
    body = C.BODY_PLACEHOLDER if body is None else _SPACES.sub(" ", "".join(body).strip())
    return title, title + " " + body


def extract_text(html: Column, titles=C.TITLE_SELECTORS, bodies=C.BODY_SELECTORS) -> Column:
    """``struct<extracted_title, extracted_content>`` of an HTML column."""
    titles = tuple(compile_selector(s) for s in titles)
    bodies = tuple(compile_selector(s) for s in bodies)

    @F.arrow_udf("extracted_title string, extracted_content string")
    def extract(pages: pa.Array) -> pa.Array:
        pairs = [page_text(page, titles, bodies) for page in pages.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([p[n] for p in pairs], pa.string()) for n in (0, 1)],
            names=["extracted_title", "extracted_content"],
        )

    # Non-deterministic to the optimizer: a filter on the result must not parse the page again.
    return extract.asNondeterministic()(html)
