"""Visible text of HTML pages in their layout.

A tree builder supplies the tags that HTML lets authors leave out; rules of visibility drop what
a browser does not show; a small layout then emits all other text with blocks on lines of their
own, blank lines where blocks have margins, numbered and nested lists, and table cells aligned in
columns. What stands in a table but in no cell is put before the table.

A page is read in one pass: a tag or comment that never ends hides the rest, as in browsers. Text
is never dropped for its place or its length, and the output stays within a small multiple of the
page: cells wider than ``WIDE`` get lines of their own, tables wider than ``LINE`` are not aligned.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .support import by_batch

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template noscript iframe object canvas audio video datalist map noframes noembed "
                   "desc defs metadata symbol annotation annotation-xml".split())
IN_HEAD = frozenset("base link meta title script style template noscript".split())
# Elements whose content is no markup; of the second kind it may hold character references.
RAW = frozenset("script style xmp iframe noembed noframes noscript plaintext".split())
RAW_TEXT = frozenset(("textarea", "title"))
# Blocks with a blank line around them, and blocks without.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl blockquote pre table figure fieldset hr listing xmp".split())
BLOCKS = SPACED | frozenset("html body div section article header footer nav main aside address center form details summary dialog li dt dd "
                            "figcaption legend hgroup search caption thead tbody tfoot tr td th optgroup option".split())
CLOSES_P = (SPACED | frozenset("div section article header footer nav main aside address center form details summary dialog li dt dd "
                               "figcaption hgroup search".split()))
# Inline elements that change no layout unless they have one of the attributes.
PLAIN = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup "
                  "time tt u var".split())
STYLED = ("style", "hidden")
# What a start tag closes, and the elements it does not look beyond.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "rt": {"rt", "rp"}, "rp": {"rt", "rp"}}
LIMITS = {"li": {"ul", "ol", "menu", "td", "th", "table"}, "dt": {"dl", "td", "th", "table"}, "dd": {"dl", "td", "th", "table"}}
CELL = {"td", "th", "caption", "table", "html", "template"}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PARTS = ("thead", "tbody", "tfoot")
IN_TABLE = frozenset((*PARTS, "tr", "td", "th", "caption", "colgroup", "col"))
# Elements whose own content is table structure; anything else inside them goes before the table.
NO_TEXT = frozenset((*PARTS, "table", "tr", "colgroup"))
# Elements deeper than this become siblings, as in browsers.
DEPTH = 200
# Widest cell and line that are aligned, columns that are placed, and levels that are indented.
WIDE, LINE, COLUMNS, LEVELS = 100, 300, 1000, 12
INDENT, GAP = "    ", "  "
SPACE = re.compile(r"[ \t\n\f\r]+")
STYLE = re.compile(r"(?:^|;)\s*(display|visibility|white-space)\s*:\s*([a-z-]+)")
NAME = re.compile(r"[a-zA-Z][^ \t\n\f\r/>]*")
PLAIN_PART = re.compile(r"[^>\"'=]*")
ATTRIBUTE = re.compile(r"""([^ \t\n\f\r/>="'][^ \t\n\f\r/>=]*)(?:[ \t\n\f\r]*=[ \t\n\f\r]*(?:"([^"]*)"|'([^']*)'|([^ \t\n\f\r>]*)))?""")
COMMENT_END = re.compile(r"--!?>")


class Node:
    __slots__ = ("tag", "attrs", "children", "skipped")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []
        self.skipped = 0  # plain elements of this tag that are open inside


def _tag_end(html: str, at: int) -> int:
    """Place of the ">" that ends a tag whose attributes begin at ``at``; -1 if there is none."""
    while True:
        at = PLAIN_PART.match(html, at).end()
        if at >= len(html):
            return -1
        if html[at] == ">":
            return at
        if html[at] == "=":
            at = SPACE.match(html, at + 1).end() if SPACE.match(html, at + 1) else at + 1
            if html[at:at + 1] in ("'", '"') and at < len(html):
                at = html.find(html[at], at + 1)
                if at < 0:
                    return -1
                at += 1
        else:
            at += 1


def tokens(html: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """Kind ("text", "start" or "end"), text or tag, and attributes of the parts of a page, in one pass."""
    at, n, none = 0, len(html), {}
    while at < n:
        less = html.find("<", at)
        if less < 0:
            yield "text", unescape(html[at:]), none
            return
        after = html[less + 1:less + 2]
        name = NAME.match(html, less + 1 + (after == "/"))
        if not name and after not in ("!", "?", "/"):
            yield "text", unescape(html[at:less + 1]), none
            at = less + 1
            continue
        if less > at:
            yield "text", unescape(html[at:less]), none
        if not name or after in ("!", "?"):
            if html.startswith("<!--", less):
                found = COMMENT_END.search(html, less + 2) if html.startswith((">", "->"), less + 4) else COMMENT_END.search(html, less + 4)
                end = found.end() if found else n
            elif html.startswith("</", less) and less + 2 == n:
                yield "text", "</", none
                end = n
            else:
                end = html.find(">", less) + 1 or n
            at = end
            continue
        end = _tag_end(html, name.end())
        if end < 0:
            return
        tag, body = name[0].lower(), html[name.end():end]
        at = end + 1
        if after == "/":
            yield "end", tag, none
            continue
        attrs: dict[str, str] = {}
        if body and body != "/":
            for key, double, single, bare in ATTRIBUTE.findall(body):
                attrs.setdefault(key.lower(), unescape(double or single or bare))
        yield "start", tag, attrs
        if tag in RAW or tag in RAW_TEXT:
            found = re.compile(f"</{tag}(?=[ \\t\\n\\f\\r/>])", re.IGNORECASE).search(html, at) if tag != "plaintext" else None
            end = found.start() if found else n
            if end > at:
                yield "text", unescape(html[at:end]) if tag in RAW_TEXT else html[at:end], none
            at = end


class Builder:
    """Tree of a page. Tags that are missing are supplied; end tags without a start are left out."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.there: Counter[str] = Counter()  # open elements by tag
        self.deep: list[tuple[str, bool]] = []  # tags that are open below DEPTH, and whether they hide
        self.deep_there: Counter[str] = Counter()
        self.hiding = 0

    def _cut(self, k: int) -> None:
        """Close the open elements from the k-th on."""
        if k < len(self.open):
            self.there.subtract(n.tag for n in self.open[k:])
            del self.open[k:]
            self.deep.clear()
            self.deep_there.clear()
            self.hiding = 0

    def _close(self, tags: set[str] | frozenset[str], limits: set[str]) -> bool:
        """Close the innermost open element of ``tags`` and all inside it, unless a limit comes first."""
        if any(self.there[t] > 0 for t in tags):
            for k in range(len(self.open) - 1, 0, -1):
                tag = self.open[k].tag
                if tag in tags:
                    self._cut(k)
                    return True
                if tag in limits:
                    return False
        return False

    def _table(self) -> int | None:
        """Place of the innermost open table."""
        if self.there["table"] > 0:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag == "table":
                    return k
                if self.open[k].tag == "template":
                    return None
        return None

    def _add(self, item: Node | str) -> None:
        """Into the open element, or before its table where that has no place for it."""
        if self.open[-1].tag not in NO_TEXT or (isinstance(item, Node) and (item.tag in IN_TABLE or item.tag in ("script", "style", "template"))):
            self.open[-1].children.append(item)
            return
        k = self._table()
        if k is None:
            self.open[-1].children.append(item)
            return
        above, table = self.open[k - 1].children, self.open[k]
        place = next((i for i in range(len(above) - 1, -1, -1) if above[i] is table), len(above))
        above.insert(place, item)

    def _push(self, node: Node) -> None:
        self._add(node)
        if node.tag not in VOID:
            self.open.append(node)
            self.there[node.tag] += 1

    def _below(self, node: Node) -> None:
        """An element below DEPTH: its text goes on in the deepest open element, if it is shown."""
        hides = not _visible(node)
        if not self.hiding and not hides:
            self.open[-1].children.append(Node(node.tag, node.attrs) if node.tag in VOID or node.tag in BLOCKS else " " if node.tag == "text" else "")
        if node.tag not in VOID:
            self.deep.append((node.tag, hides))
            self.deep_there[node.tag] += 1
            self.hiding += hides

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body"):
            for k, v in attrs.items():
                self.root.attrs.setdefault(k, v)
            self._close({"head"}, set())
            return
        if len(self.open) >= DEPTH:
            self._below(Node(tag, attrs))
            return
        if tag == "head":
            if not self.root.children:
                self._push(Node("head", attrs))
            return
        if tag not in IN_HEAD:
            self._close({"head"}, {"template"})
        if tag in PLAIN and not any(a in attrs for a in STYLED):
            if self.there[tag] > 0:
                next(n for n in reversed(self.open) if n.tag == tag).skipped += 1
            return
        if tag in CLOSES_P:
            self._close({"p"}, CELL)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self._cut(len(self.open) - 1)
        k = self._table()
        if tag in IN_TABLE:
            if not self._row_place(tag, k):
                return
        elif tag == "table":
            if self.open[-1].tag in NO_TEXT and k is not None:
                self._cut(k)
        elif tag == "form":
            if self.open[-1].tag in NO_TEXT:
                return
        elif tag in CLOSES:
            self._close(CLOSES[tag], LIMITS.get(tag, CELL))
        self._push(Node(tag, attrs))

    def _row_place(self, tag: str, k: int | None) -> bool:
        """Go back to where ``tag`` belongs in the table, with the tags it needs; False where it has no place."""
        if k is None:
            if tag not in ("tr", "td", "th"):
                return False
            k = len(self.open)
            self._push(Node("table"))
        keep = k + 1
        if tag in ("tr", "td", "th") and keep < len(self.open) and self.open[keep].tag in PARTS:
            keep += 1
        if tag in ("td", "th") and keep < len(self.open) and self.open[keep].tag == "tr":
            keep += 1
        self._cut(keep)
        if tag in ("td", "th") and self.open[-1].tag != "tr":
            self._push(Node("tr"))
        return True

    def end(self, tag: str) -> None:
        if self.deep_there[tag] > 0:
            while True:
                old, hides = self.deep.pop()
                self.deep_there[old] -= 1
                self.hiding -= hides
                if old == tag:
                    break
            if not self.hiding and tag in BLOCKS:
                self.open[-1].children.append(Node("div"))
        elif tag == "br":
            self._add(Node("br"))
        elif tag == "head":
            self._close({"head"}, set())
        elif tag in HEADINGS:
            self._close(HEADINGS, CELL)
        elif tag in PLAIN and self.there[tag] > 0 and (node := next(n for n in reversed(self.open) if n.tag == tag)).skipped:
            node.skipped -= 1
        elif tag not in ("html", "body") and tag not in VOID:
            inside = tag in IN_TABLE
            if not self._close({tag}, {"table", "template"} if inside else {"template"} if tag == "table" else CELL) and tag == "p":
                self._add(Node("p"))  # an end without a start is an empty paragraph

    def text(self, data: str) -> None:
        top = self.open[-1]
        if self.hiding:
            return
        if top.tag == "head":
            if not data.strip(" \t\n\f\r"):
                return
            self._cut(len(self.open) - 1)
            top = self.open[-1]
        if top.tag in NO_TEXT:
            if data.strip(" \t\n\f\r"):
                self._add(data)
        else:
            top.children.append(data)


def parse(html: str) -> Node:
    builder = Builder()
    for kind, text, attrs in tokens(html):
        if kind == "text":
            builder.text(text)
        elif kind == "start":
            builder.start(text, attrs)
        else:
            builder.end(text)
    return builder.root


def width(text: str) -> int:
    """Columns a text takes: wide letters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Page:
    """Lines of a block; blank lines are kept back until text follows."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = self.glue = False
        self.indents: list[str] = []
        self.mark = ""

    def word(self, text: str) -> None:
        """Inline text whose white space collapses."""
        parts = SPACE.split(text)
        if len(parts) > 1 and not parts[0]:
            self.glue = True
        words = [p for p in parts if p]
        if not words:
            return
        if self.line and self.glue:
            self.line.append(" ")
        self.line.append(" ".join(words).replace("\xa0", " "))
        self.glue = len(parts) > 1 and not parts[-1]

    def exact(self, text: str) -> None:
        """Text whose white space stays."""
        first, *others = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line.append(first.expandtabs(8))
        for other in others:
            self.end(keep=True)
            self.line.append(other.expandtabs(8))
        self.glue = False

    def put(self, text: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        lead = "".join(self.indents[:LEVELS])
        if self.mark:
            # the mark stands in the last indent
            lead = lead[:len(lead) - len(self.indents[-1])] + self.mark if 0 < len(self.indents) <= LEVELS else lead + self.mark
            self.mark = ""
        self.lines.append((lead + text).rstrip())

    def end(self, keep: bool = False) -> None:
        """End the line; an empty one counts only with ``keep``."""
        text = "".join(self.line)
        self.line, self.glue = [], False
        if text or keep:
            self.put(text)

    def gap(self) -> None:
        self.end()
        self.blank = True

    def text(self) -> str:
        self.end()
        out, empty = [], True
        for line in self.lines:
            if line or not empty:
                out.append(line)
            empty = not line
        while out and not out[-1]:
            out.pop()
        return "\n".join(out)


def styles(node: Node) -> dict[str, str]:
    style = node.attrs.get("style")
    return dict(STYLE.findall(style.lower())) if style else {}


def shown(node: Node, style: dict[str, str]) -> bool:
    """Whether the element is laid out at all."""
    if node.tag in HIDDEN or style.get("display") == "none" or (node.attrs.get("hidden", "until-found") != "until-found"):
        return False
    return not (node.tag == "dialog" and "open" not in node.attrs)


def _visible(node: Node) -> bool:
    style = styles(node)
    return shown(node, style) and style.get("visibility", "visible") == "visible"


def number(text: str | None, default: int, low: int, high: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return max(low, min(high, int(found[1]))) if found else default


def layout(node: Node, page: Page, visible: bool = True, exact: bool = False) -> None:
    """Emit the visible text inside ``node``."""
    children = node.children
    if node.tag == "details" and "open" not in node.attrs:
        children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
    elif node.tag == "select":
        options = [o for c in children if isinstance(c, Node) for o in ([c] if c.tag == "option" else c.children) if isinstance(o, Node) and o.tag == "option"]
        children = [o for o in options if "selected" in o.attrs][:1] or options[:1]
    item = number(node.attrs.get("start"), 1, -10**9, 10**9) if node.tag == "ol" else None
    for child in children:
        if isinstance(child, str):
            if visible:
                page.exact(child) if exact else page.word(child)
            continue
        tag, style = child.tag, styles(child)
        if tag == "br":
            if visible:
                page.end(keep=True)
            continue
        if tag == "input":
            if visible and child.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                page.word(child.attrs.get("value", ""))
            continue
        if not shown(child, style):
            continue
        seen = visible if "visibility" not in style else style["visibility"] == "visible"
        kept = tag in ("pre", "textarea", "listing", "xmp") or (style["white-space"].startswith("pre") if "white-space" in style else exact)
        display = style.get("display", "block" if tag in BLOCKS else "inline")
        if tag == "table":
            page.gap()
            table(child, page, seen, kept)
            page.gap()
            continue
        block = display not in ("inline", "inline-block", "inline-flex", "contents") and (tag in BLOCKS or display in ("block", "flex", "grid", "list-item", "table"))
        if not block:
            apart = tag == "text"  # a label of a drawing stands alone
            page.glue |= apart
            layout(child, page, seen, kept)
            page.glue |= apart
            continue
        nested = tag in ("ul", "ol", "menu", "dl") and node.tag in ("li", "dd")
        spaced = tag in SPACED and not nested
        page.gap() if spaced else page.end()
        indent = ""
        if tag == "li":
            if node.tag == "ol":
                item = number(child.attrs.get("value"), item, -10**9, 10**9)
                page.mark, item = f"{item}. ", item + 1
            else:
                page.mark = "- "
            indent = " " * len(page.mark)
        elif tag in ("dd", "blockquote"):
            indent = INDENT
        if indent:
            page.indents.append(indent)
        first = child.children[0] if tag == "pre" and child.children else None
        if isinstance(first, str) and first.startswith("\n"):  # the line break after <pre> does not count
            child.children[0] = first[1:]
        layout(child, page, seen, kept)
        page.gap() if spaced else page.end()
        if indent:
            page.indents.pop()
            page.mark = ""


def table_rows(node: Node, visible: bool, captions: list, out: list) -> list[tuple[Node, bool]]:
    """Rows of a table in order, heads before bodies before feet, each with its visibility."""
    for child in node.children:
        if isinstance(child, str) or not shown(child, style := styles(child)):
            continue
        seen = visible if "visibility" not in style else style["visibility"] == "visible"
        if child.tag == "caption":
            captions.append((child, seen))
        elif child.tag == "tr":
            out.append((node.tag, child, seen))
        elif child.tag in PARTS:
            table_rows(child, seen, captions, out)
    order = {"thead": 0, "tfoot": 2}
    return [(tr, seen) for _, tr, seen in sorted(out, key=lambda r: order.get(r[0], 1))]


def table(node: Node, page: Page, visible: bool, exact: bool) -> None:
    """Lay out a table: cells of a column begin in the same place, cells of many lines stand beside each other.

    A cell with a line wider than WIDE stands on lines of its own between those before and after it.
    """
    captions: list[tuple[Node, bool]] = []
    rows = table_rows(node, visible, captions, [])
    for caption, seen in captions:
        layout(caption, page, seen, exact)
        page.end()
    covered: dict[int, int] = {}  # column: the row up to which a cell above covers it
    laid = []
    for k, (row, row_seen) in enumerate(rows):
        at, cells = 0, []
        for cell in row.children:
            if isinstance(cell, str) or not shown(cell, style := styles(cell)):
                continue
            while covered.get(at, 0) > k:
                at += 1
            span = number(cell.attrs.get("colspan"), 1, 1, COLUMNS)
            below = number(cell.attrs.get("rowspan"), 1, 1, 65534)
            inner = Page()
            layout(cell if cell.tag in ("td", "th") else _held(cell), inner, row_seen if "visibility" not in style else style["visibility"] == "visible", exact)
            lines = inner.text().split("\n")
            cells.append((at, span, lines, max(map(width, lines))))
            if below > 1:
                covered.update(dict.fromkeys(range(at, min(at + span, COLUMNS)), k + below))
            at += span
        laid.append(cells)
    # columns where no cell begins take no room
    begins = sorted({at for cells in laid for at, *_ in cells})
    room: dict[int, int] = dict.fromkeys(begins, 0)
    after = dict(zip(begins, begins[1:], strict=False))
    for cells in laid:
        for at, span, _, wide in cells:
            if at in after and at + span <= after[at] and wide <= WIDE:
                room[at] = max(room[at], wide)
    places, x = dict.fromkeys(begins, 0), 0
    for at in begins:
        places[at] = x
        x += room[at] + len(GAP) if room[at] else 0
    if x > LINE:
        places = dict.fromkeys(begins, 0)
    for cells in laid:
        beside: list[tuple[int, list[str]]] = []
        for at, _, lines, wide in cells:
            if wide <= WIDE:
                beside.append((places[at], lines))
                continue
            _beside(beside, page)
            beside = []
            for line in lines:
                if line:
                    page.put(line)
        _beside(beside, page)


def _beside(cells: list[tuple[int, list[str]]], page: Page) -> None:
    """Cells of a row beside each other, each from its place on."""
    for k in range(max((len(lines) for _, lines in cells), default=0)):
        line, taken = "", 0
        for place, lines in cells:
            if k < len(lines) and lines[k]:
                pad = " " * (place - taken) if place > taken or not line else GAP
                line += pad + lines[k]
                taken += len(pad) + width(lines[k])
        if line.strip():
            page.put(line)


def _held(node: Node) -> Node:
    out = Node("td")
    out.children = [node]
    return out


def render(html: str) -> str:
    """Visible text of a page; an empty page has none."""
    root, page = parse(html), Page()
    if shown(root, style := styles(root)):
        layout(root, page, style.get("visibility", "visible") == "visible")
    return page.text()


def extract(pages: DataFrame) -> DataFrame:
    """page_id and text of each row of ``pages(page_id, html)``.

    Null html is an empty page, whose text is empty; null and repeated page_ids are rows like
    others; an empty table gives no rows; other columns are not read.
    """
    def task():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [render(h or "") for h in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])
        return one
    return by_batch(pages.select("page_id", "html"), "page_id long, text string", task)
