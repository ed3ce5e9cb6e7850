"""Layout-aware rendering of HTML to text.

A small tree builder (implied ends of p, li, dt, dd, option, table parts; void
elements; stray end tags) turns a page into nested elements, visibility rules
drop what a reader doesn't see (of a drawing: all but its text), and a renderer emits all visible text: blocks
on lines of their own with blank lines around paragraphs, list items with
bullets or numbers, table cells in aligned columns, preformatted text as is.

Scale: one pass over the pages without a shuffle; a page's work and memory are
linear in its length, whatever its nesting and its open quotes: no step
recurses or goes back, open elements are found by name, and no table column is
padded to more than ``ALIGNED`` characters.

Defined results: a null or empty page has an empty text; broken markup is text
or ignored as a browser would, a tag with a quote that is never closed is
text; very long pages have no limit; repeated and null ids are separate rows;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

# Elements by behaviour, from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noframes xmp".split())
HIDDEN = frozenset("head script style template noscript iframe noframes object audio video canvas datalist area param source "
                   "track select".split())
# Of svg and math: elements whose content is HTML again, HTML elements that end a drawing or formula left open,
# elements whose parts stand apart, and elements that are never shown.
FOREIGN = frozenset(["svg", "math"])
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
                     "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
APART = frozenset("mfrac mtable mtr".split())
UNDRAWN = frozenset("title desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient filter".split())
UNSET = frozenset("annotation annotation-xml mphantom".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
                  "tbody td tfoot th thead title tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr menu dir fieldset".split())
ENDS_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption title legend".split())
# An opening tag ends the open element named here, unless one of the walls stands between.
IMPLIED = {
    "li": ("li", frozenset("ul ol menu dir".split())),
    "dt": ("dt dd", frozenset(["dl"])), "dd": ("dt dd", frozenset(["dl"])),
    "option": ("option", frozenset("select datalist".split())), "optgroup": ("option optgroup", frozenset(["select"])),
    "td": ("td th", frozenset("table tr".split())), "th": ("td th", frozenset("table tr".split())),
    "tr": ("tr", frozenset("table".split())),
    "tbody": ("tbody thead tfoot caption colgroup", frozenset(["table"])),
    "thead": ("tbody thead tfoot caption colgroup", frozenset(["table"])),
    "tfoot": ("tbody thead tfoot caption colgroup", frozenset(["table"])),
    "body": ("head", frozenset()),
}
_TOKEN = re.compile(r"<(?:[!?]|(/?)([a-zA-Z][^\s/>]*))")
_SPECIAL = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict):
        self.name, self.attributes, self.children = name, attributes, []


def _attributes(text: str) -> dict:
    out: dict = {}
    if text and not text.isspace():
        for name, value in _ATTRIBUTE.findall(text):
            out.setdefault(name.lower(), html.unescape(value.strip("\"'")) if value else "")
    return out


class _Tokens:
    """Tags, comments and the like of a page, from left to right.  Every part
    of the page is looked at a bounded number of times: a tag whose quote is
    never closed is text, and the places where one was met are remembered."""

    def __init__(self, page: str):
        self.page, self.open_quotes = page, set()

    def _tag_end(self, at: int) -> int:
        """Where the tag's attributes end (at ``>`` or the page's end), -1 if
        a quote in them is not closed."""
        met = []
        while (m := _SPECIAL.search(self.page, at)) and m[0] != ">":
            k = m.start()
            if k in self.open_quotes:
                break
            met.append(k)
            at = self.page.find(m[0], k + 1) + 1
            if not at:
                break
        else:
            return m.start() if m else len(self.page)
        self.open_quotes.update(met)
        return -1

    def next(self, at: int):
        """(start, end, closing, name, attributes, character data) of the next
        token from ``at`` on, or None; name is None for what is no tag."""
        page = self.page
        while m := _TOKEN.search(page, at):
            start = m.start()
            if m[2] is not None:
                end = self._tag_end(m.end())
                if end >= 0:
                    return start, min(end + 1, len(page)), bool(m[1]), m[2].lower(), page[m.end():end], None
                at = start + 1
                continue
            for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<", ">")):
                if page.startswith(opening, start):
                    end = page.find(closing, start + len(opening))
                    inner = page[start + len(opening):end if end >= 0 else len(page)]
                    return (start, end + len(closing) if end >= 0 else len(page), False, None, "",
                            inner if closing == "]]>" else None)
        return None


def build(page: str) -> Node:
    """The tree of a page; children are nodes and strings."""
    root = Node("#root", {})
    stack = [root]
    foreign = [False]  # of the open elements: the content isn't HTML
    held: dict[str, list[int]] = {}  # places of the open elements by name

    def close(depth: int) -> None:
        for node in reversed(stack[depth:]):
            held[node.name].pop()
        del stack[depth:], foreign[depth:]

    def break_out() -> None:
        depth = len(stack)
        while foreign[depth - 1]:
            depth -= 1
        close(depth)

    def last(names) -> int:
        return max((held[n][-1] for n in names if held.get(n)), default=0)

    def find(names, walls) -> int:
        """Place of the innermost open element of these names, 0 if there is
        none or a wall stands further in."""
        place = last(names)
        return place if place and place >= last(walls) else 0

    tokens = _Tokens(page)
    at, size = 0, len(page)
    low = None
    while at < size:
        token = tokens.next(at)
        text = page[at:token[0]] if token else page[at:]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not token:
            break
        _, at, closing, name, attributes, data = token
        if name is None:
            if data is not None:
                stack[-1].children.append(data)
            continue
        if foreign[-1] and (name in ("p", "br") if closing else name in BREAKOUT):
            break_out()
        if closing:
            if held.get(name):
                walls = frozenset() if name in ("table", "body", "html") else frozenset(["table"]) if name not in (
                    "td", "th", "tr", "tbody", "thead", "tfoot", "caption") else frozenset()
                depth = find((name,), walls)
                if depth:
                    close(depth)
            elif name == "p":
                stack[-1].children.append(Node("p", {}))
            elif name == "br":
                stack[-1].children.append(Node("br", {}))
            continue
        if name in ENDS_P and held.get("p"):
            depth = find(("p",), frozenset("td th table button li dd dt caption".split()))
            if depth:
                close(depth)
        if name in IMPLIED:
            names, walls = IMPLIED[name]
            depth = find(tuple(names.split()), walls)
            if depth:
                close(depth)
        node = Node(name, _attributes(attributes))
        stack[-1].children.append(node)
        strange = foreign[-1] or name in FOREIGN
        if name in VOID or (strange and attributes.rstrip().endswith("/")):
            continue
        if name in RAW:
            if low is None:
                low = page.lower()
                if len(low) != size:  # a letter whose small form is longer
                    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in page)
            end = low.find("</" + name, at)
            inner = page[at:end] if end >= 0 else page[at:]
            node.children.append(html.unescape(inner) if name in ("title", "textarea") else inner)
            close_at = page.find(">", end) if end >= 0 else -1
            at = close_at + 1 if close_at >= 0 else size
            continue
        if attributes.rstrip().endswith("/") and name not in BLOCK:
            continue
        stack.append(node)
        foreign.append(strange and name not in INTEGRATION)
        held.setdefault(name, []).append(len(stack) - 1)
    return root


def visible(node: Node) -> bool:
    a = node.attributes
    if node.name in HIDDEN or node.name in UNSET or (node.name == "dialog" and "open" not in a):
        return False
    if not a:
        return True
    return not ("hidden" in a or (node.name == "input" and a.get("type", "").lower() == "hidden") or _UNSEEN.search(a.get("style", "")))


def drawn(node: Node) -> bool:
    """Whether an element of a drawing is shown."""
    a = node.attributes
    return node.name not in UNDRAWN and a.get("display") != "none" and a.get("visibility") not in ("hidden", "collapse")


class _Page:
    """Lines of text with pending spacing: 0 none, 1 new line, 2 blank line."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap, self.space, self.pending = 0, False, ""

    def inline(self, text: str, keep: bool = False) -> None:
        if keep:
            first, *rest = text.split("\n")
            self._put(first, True)
            for r in rest:
                self.newline()
                self._put(r, True)
            return
        for i, word in enumerate(_BLANK.split(text)):
            if i:
                self.space = True
            if word:
                self._put(word, False)

    def _put(self, text: str, keep: bool) -> None:
        if not text:
            return
        if self.gap:
            self.flush()
            if self.lines and self.gap == 2 and self.lines[-1]:
                self.lines.append("")
            self.gap = 0
        if self.pending:
            self.line.append(self.pending)
            self.pending, self.space = "", False
        if self.space and self.line and not keep:
            self.line.append(" ")
        self.space = False
        self.line.append(text)

    def newline(self) -> None:
        self.lines.append("".join(self.line).rstrip())
        self.line, self.space = [], False

    def flush(self) -> None:
        if self.line:
            self.newline()

    def block(self, spaced: bool) -> None:
        self.gap = max(self.gap, 2 if spaced else 1)
        self.space = False

    def text(self) -> str:
        self.flush()
        return "\n".join(self.lines).strip("\n")


#: Cells up to this length are aligned; a longer one moves the rest of its row.
ALIGNED = 80


def _columns(rows: list[list[str]]) -> list[str]:
    """Rows of one-line cells in aligned columns; the text stays linear in the
    cells, as no column is wider than ``ALIGNED``."""
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            if i == len(widths):
                widths.append(0)
            if len(cell) <= ALIGNED:
                widths[i] = max(widths[i], len(cell))
    return [" | ".join(c.ljust(widths[i]) if i < len(row) - 1 else c for i, c in enumerate(row)).rstrip() for row in rows]


def render(root: Node) -> tuple[str, int, int]:
    """(visible text, tables, list items).  Works off a stack of steps; table
    cells are pages of their own until their table ends."""
    page = _Page()
    tables = items = 0
    lists: list[list] = []  # [kind, next number]
    rows: list[list[list[str]]] = []  # of the open tables
    outer: list[_Page] = []
    pre = 0
    steps: list[tuple[str, object]] = [("node", root)]
    while steps:
        what, x = steps.pop()
        if what == "text":
            page.inline(x, pre > 0)
        elif what != "end":
            name = x.name
            if not visible(x) or (what != "node" and not drawn(x)):
                continue
            if name == "svg" or what != "node":  # of a drawing: its labels, apart from what is beside
                kind = "node" if name == "foreignobject" else "label" if what == "label" or name == "text" else "drawn"
                if what != "label":
                    page.inline(" ")
                    steps.append(("text", " "))
                steps.extend(("text" if isinstance(c, str) else kind, c) for c in reversed(x.children)
                             if kind != "drawn" or not isinstance(c, str))
                continue
            if name in APART:
                steps.append(("text", " "))
                for c in reversed(x.children):
                    steps += [("text" if isinstance(c, str) else "node", c), ("text", " ")]
                continue
            if name == "br":
                if page.line or page.gap == 0:
                    page.newline()
                continue
            if name == "img":
                page.inline(" " + x.attributes.get("alt", "") + " ")
                continue
            if name == "wbr":
                continue
            if name == "hr":
                page.block(True)
                continue
            steps.append(("end", x))
            steps.extend(("text" if isinstance(c, str) else "node", c) for c in reversed(x.children))
            if name in ("td", "th") and rows:
                if not rows[-1]:
                    rows[-1].append([])
                outer.append(page)
                page = _Page()
                continue
            if name in BLOCK:
                page.block(name in SPACED and not (name in ("ul", "ol", "menu", "dir") and lists))
            if name == "pre":
                pre += 1
            elif name in ("ul", "ol", "menu", "dir"):
                start = x.attributes.get("start", "1")
                lists.append([name, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif name == "li":
                items += 1
                page.pending = "  " * max(0, len(lists) - 1)
                if lists and lists[-1][0] == "ol":
                    page.pending += f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                else:
                    page.pending += "- "
            elif name == "dd":
                page.pending = "  "
            elif name == "table":
                tables += 1
                rows.append([])
            elif name == "tr" and rows:
                rows[-1].append([])
        else:
            name = x.name
            if name in ("td", "th") and rows and outer:
                cell = _BLANK.sub(" ", page.text()).strip()
                page = outer.pop()
                rows[-1][-1].append(cell)
                span = x.attributes.get("colspan", "1")
                rows[-1][-1] += [""] * (min(int(span), 1000) - 1 if re.fullmatch(r"\d{1,9}", span) else 0)
                continue
            if name in ("pre",):
                pre -= 1
            elif name in ("ul", "ol", "menu", "dir") and lists:
                lists.pop()
            elif name == "li":
                page.pending = ""
            elif name == "table" and rows:
                for line in _columns([r for r in rows.pop() if any(r)]):
                    page.block(False)
                    page.inline(line, True)
            if name in BLOCK:
                page.block(name in SPACED and not (name in ("ul", "ol", "menu", "dir") and lists))
    return page.text(), tables, items


def page_text(page: str | None) -> tuple[str, int, int]:
    return render(build(page)) if page else ("", 0, 0)


def _extract(batches):
    for batch in batches:
        column = batch.column("html")
        for a in range(0, len(column), 64):
            part = [page_text(p) for p in column.slice(a, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id").slice(a, 64), pa.array([p[0] for p in part], pa.string()),
                pa.array([len(p[0]) for p in part], pa.int64()), pa.array([p[1] for p in part], pa.int32()),
                pa.array([p[2] for p in part], pa.int32())], ["page_id", "text", "n_chars", "n_tables", "n_items"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, html) -> page_id, text, n_chars, n_tables, n_items."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "html").mapInArrow(
        _extract, f"page_id {kind}, text string, n_chars long, n_tables int, n_items int")
