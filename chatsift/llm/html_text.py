"""HTML extraction by layout: a tree with implied tags, visibility rules, and a text renderer.

The tokenizer scans a page once; the builder closes and opens the tags that
HTML implies (a paragraph before a block, list items, rows, cells, options);
the renderer walks the tree without recursion and emits all visible text:
blocks on their own lines, a blank line between paragraphs, bullets and
numbers, preformatted text as it is, and tables with aligned columns.

One row of Python work a page, in Arrow batches; nothing is shuffled.  Null and
empty pages give an empty text.  Broken markup never fails: a stray ``<`` is
text, unknown tags are inline, unclosed tags end with the page.
"""

from __future__ import annotations

import html
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe object canvas audio video datalist "
                   "noembed noframes title".split())
#: Inside <svg> only text elements show; inside <math> all but the annotations.
SVG_HIDDEN = frozenset("title desc defs metadata symbol clippath mask marker pattern lineargradient radialgradient filter".split())
MATH_HIDDEN = frozenset("annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
                  "search section summary table tbody td tfoot th thead tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure".split())
CLOSES_P = BLOCK - frozenset("body html li dd dt option td th tr tbody thead tfoot caption legend".split())
#: Opening the key closes an open element of the first set, unless one of the second stands between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}), "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
MAX_COLSPAN = 1000  # as in HTML

_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<decl>[!?])[^>]*>?|/(?P<close>[a-zA-Z][^\s/>]*)[^>]*>?"
                  r"|(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?P<end>>|\Z)"
                  r"|(?P<loose>[a-zA-Z][^\s/>]*)[^>]*>?)", re.S)
#: Attributes that matter here; the others are not read.
_USED = re.compile(r"hidden|style|type|value|alt|colspan|start|selected|label|multiple|size", re.I)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)|content-visibility\s*:\s*hidden)\b", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "hidden")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []
        a = self.attrs
        self.hidden = bool(a) and ("hidden" in a or tag == "input" and a.get("type", "").lower() == "hidden"
                                   or "style" in a and bool(_HIDING.search(a["style"])))


def _attributes(source: str) -> dict:
    found: dict = {}
    for name, double, single, bare in _ATTR.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


def build_tree(page: str) -> Node:
    """The element tree of a page; text nodes are strings in ``children``."""
    root = Node("#root")
    stack = [root]
    opened: dict[str, int] = {}  # how many elements of a name are open
    at, n = 0, len(page)

    def text(s: str) -> None:
        if s:
            stack[-1].children.append(html.unescape(s) if "&" in s else s)

    def push(node: Node) -> None:
        stack.append(node)
        opened[node.tag] = opened.get(node.tag, 0) + 1

    def close_to(depth: int) -> None:
        for node in stack[depth:]:
            opened[node.tag] -= 1
        del stack[depth:]

    def imply(closing: set, barriers: set) -> None:
        """Closes the outermost open element of ``closing`` that no barrier hides."""
        if not any(opened.get(t) for t in closing):
            return
        depth = None
        for d in range(len(stack) - 1, 0, -1):
            if stack[d].tag in barriers:
                break
            if stack[d].tag in closing:
                depth = d
        if depth is not None:
            close_to(depth)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        m = _TAG.match(page, lt)
        if m is None:
            text("<")
            at = lt + 1
            continue
        at = m.end()
        name = (m["open"] or m["loose"] or "").lower()
        if name:
            attrs = _attributes(m["attrs"]) if m["attrs"] and _USED.search(m["attrs"]) else {}
            if name in CLOSES_P:
                imply({"p"}, {"td", "th", "table", "button", "object"})
            if name in IMPLIED:
                imply(*IMPLIED[name])
            if name in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                row = Node("tr")
                stack[-1].children.append(row)
                push(row)
            node = Node(name, attrs)
            if (name in MATH_HIDDEN and opened.get("math")
                    or name in SVG_HIDDEN and opened.get("svg") and not opened.get("foreignobject")):
                node.hidden = True
            stack[-1].children.append(node)
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                body = page[at:end.start()] if end else page[at:]
                node.children.append(html.unescape(body) if name in ("textarea", "title") else body)
                at = end.end() if end else n
            elif name not in VOID and not (m["attrs"] or "").endswith("/") or name in BLOCK and name not in VOID:
                push(node)
        elif m["close"]:
            name = m["close"].lower()
            if name == "br":
                stack[-1].children.append(Node("br"))
            elif name == "p" and not opened.get("p"):
                stack[-1].children.append(Node("p"))
            elif opened.get(name):
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d].tag == name:
                        close_to(d)
                        break
                    if stack[d].tag in ("td", "th", "table") and name not in ("td", "th", "tr", "tbody", "thead", "tfoot", "table"):
                        break  # a stray end tag does not leave its cell
                    if stack[d].tag == "table" and name != "table":
                        break
    return root


class _Page:
    """Lines of output: inline text joins the open line, blocks break it, spaced blocks leave a blank line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.open: list[str] = []
        self.space = False      # blank seen since the last inline text
        self.gap = False        # a blank line is due before the next line
        self.prefix: list[str] = []
        self.marker: str | None = None

    def inline(self, s: str) -> None:
        if "\n" in s or "\t" in s or "\f" in s or "  " in s:
            s = _BLANKS.sub(" ", s)
        body = s.strip(" ")
        if body:
            if self.open and (self.space or s[0] == " "):
                self.open.append(" ")
            self.open.append(body)
            self.space = s[-1] == " "
        elif s:
            self.space = True

    def flush(self) -> None:
        if self.open:
            self.put("".join(self.open))
            self.open = []
        self.space = False

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        if self.marker is not None:
            self.lines.append("".join(self.prefix[:-1]) + self.marker + line)
            self.marker = None
        else:
            self.lines.append(("".join(self.prefix) + line).rstrip() if not line else "".join(self.prefix) + line)

    def text(self) -> str:
        self.flush()
        return "\n".join(self.lines)


def _cells(table: Node) -> tuple[list[Node], list[list[Node]]]:
    """The visible captions and rows of cells of a table, without those of tables inside it."""
    captions, rows, todo = [], [], [iter(table.children)]
    while todo:
        for node in todo[-1]:
            if isinstance(node, str) or node.hidden:
                continue
            if node.tag == "tr":
                rows.append([c for c in node.children if not isinstance(c, str) and c.tag in ("td", "th") and not c.hidden])
            elif node.tag == "caption":
                captions.append(node)
            elif node.tag in ("tbody", "thead", "tfoot"):
                todo.append(iter(node.children))
                break
        else:
            todo.pop()
    return captions, rows


def _loose(table: Node) -> list:
    """What a table holds outside its cells and captions, in order; browsers show it before the table."""
    out, todo = [], [iter(table.children)]
    while todo:
        for node in todo[-1]:
            if isinstance(node, str):
                if not node.isspace():
                    out.append(node)
            elif node.tag in ("tr", "tbody", "thead", "tfoot"):
                if not node.hidden:
                    todo.append(iter(node.children))
                    break
            elif node.tag not in ("td", "th", "caption", "col", "colgroup"):
                out.append(node)
        else:
            todo.pop()
    return out


def _span(cell: Node) -> int:
    value = cell.attrs.get("colspan", "1")
    return min(MAX_COLSPAN, max(1, int(value))) if value.isascii() and value.isdigit() else 1


def _grid(rows: list[list[str]], spans: list[list[int]]) -> list[str]:
    """Rows of cell texts (lines allowed) as lines with aligned columns."""
    rows_ = [[c.split("\n") for c in row] for row in rows]
    width: dict[int, int] = {}
    for row, span in zip(rows_, spans):
        col = 0
        for cell, s in zip(row, span):
            if s == 1:
                width[col] = max(width.get(col, 0), max(map(len, cell)))
            col += s
    out = []
    for row, span in zip(rows_, spans):
        for k in range(max((len(c) for c in row), default=0)):
            line, col = "", 0
            for cell, s in zip(row, span):
                room = sum(width.get(c, 0) for c in range(col, col + s)) + 3 * (s - 1)
                line += (" | " if col else "") + (cell[k] if k < len(cell) else "").ljust(room)
                col += s
            out.append(line.rstrip())
    return out


def _options(select: Node) -> list[str]:
    """The labels that a <select> shows: the selected or else first option of a menu, all options of a list box."""
    found, todo = [], [iter(select.children)]
    while todo:
        for node in todo[-1]:
            if isinstance(node, str) or node.hidden:
                continue
            if node.tag == "option":
                found.append(node)
            elif node.tag == "optgroup":
                if node.attrs.get("label"):
                    found.append(node)
                todo.append(iter(node.children))
                break
            else:
                todo.append(iter(node.children))
                break
        else:
            todo.pop()
    rows = select.attrs.get("size", "")
    if not ("multiple" in select.attrs or rows.isascii() and rows.isdigit() and int(rows) > 1):
        found = [x for x in found if x.tag == "option"]
        found = ([x for x in found if "selected" in x.attrs] or found[:1])[-1:]
    return [x.attrs.get("label") or _all_text(x) for x in found]


def _all_text(node: Node) -> str:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag not in HIDDEN:
            todo.extend(reversed(x.children))
    return "".join(out)


def _svg_texts(svg: Node) -> list[Node]:
    """The visible <text> elements and foreign content of an <svg>, in order."""
    out, todo = [], [svg]
    while todo:
        node = todo.pop()
        if isinstance(node, str) or node.hidden:
            continue
        if node.tag in ("text", "foreignobject"):
            out.append(node)
        else:
            todo.extend(reversed(node.children))
    return out


def render(root: Node) -> str:
    """All visible text of a tree.  Walks with its own stack: depth of nesting is no limit."""
    # A frame renders one box: the page, or one cell or caption of a table.
    result: list[str] = []
    frames: list[dict] = [{"page": _Page(), "work": [("enter", root, False, None)], "done": result.append}]
    while frames:
        frame = frames[-1]
        page, work = frame["page"], frame["work"]
        if not work:
            frames.pop()
            frame["done"](page.text())
            continue
        what, node, pre, extra = work.pop()
        if what == "leave":
            page.flush()
            if extra == "prefix":
                page.prefix.pop()
                page.marker = None if page.marker is not None else page.marker
            if node.tag in SPACED:
                page.gap = True
            continue
        if what == "grid":
            lines = _grid(*extra)
            for line in lines:
                page.put(line)
            page.gap = True
            continue
        if isinstance(node, str):
            if pre:
                first, *more = node.split("\n")
                page.open.append(first)
                for line in more:
                    page.put("".join(page.open))
                    page.open = [line]
            else:
                page.inline(node)
            continue
        tag = node.tag
        if node.hidden or tag in HIDDEN:
            continue
        if tag == "select":
            for label in _options(node):
                page.inline(f" {label} ")
            continue
        if tag == "svg":
            for x in reversed(_svg_texts(node)):
                work += [("enter", " ", False, None), ("enter", x, False, None), ("enter", " ", False, None)]
            continue
        if tag == "br":
            if page.open:
                page.flush()
            elif page.lines and not page.gap:
                page.put("")
            continue
        if tag == "hr":
            page.flush()
            page.gap = True
            continue
        if tag == "img" and node.attrs.get("alt", "").strip():
            page.inline(node.attrs["alt"])
            continue
        if tag == "input":
            if node.attrs.get("type", "").lower() in ("submit", "button", "reset") and node.attrs.get("value"):
                page.inline(node.attrs["value"])
            continue
        if tag == "table":
            page.flush()
            page.gap = bool(page.lines)
            captions, rows = _cells(node)
            boxes = [[""] * len(r) for r in rows]
            work.append(("grid", node, pre, (boxes, [[_span(c) for c in r] for r in rows])))
            for r in range(len(rows) - 1, -1, -1):
                for c, cell in enumerate(rows[r]):
                    if not cell.children:
                        continue
                    def put(s, r=r, c=c, boxes=boxes):
                        boxes[r][c] = s.strip("\n")
                    work.append(("box", cell, False, put))
            for x in reversed(captions):
                work.append(("enter", x, pre, None))
            for x in reversed(_loose(node)):
                work.append(("enter", x, pre, None))
            continue
        if what == "box":
            frames.append({"page": _Page(), "done": extra,
                           "work": [("enter", c, False, None) for c in reversed(node.children)]})
            continue
        mark = None
        if tag in BLOCK:
            page.flush()
            if tag in SPACED and page.marker is None and not (tag in ("ul", "ol") and page.prefix):
                page.gap = bool(page.lines)
            if tag == "li":
                mark = "- "
                if extra is not None:
                    mark = f"{extra}. "
            elif tag in ("blockquote", "dd"):
                page.prefix.append("  ")
                mark = ""
            if tag == "li":
                page.prefix.append(" " * len(mark))
                page.marker = mark
            work.append(("leave", node, pre, "prefix" if mark is not None else None))
        inner_pre = pre or tag in ("pre", "textarea", "xmp")
        number = None
        if tag == "ol":
            first = node.attrs.get("start", "1")
            number = int(first) if re.fullmatch(r"-?\d{1,9}", first) else 1
        children = []
        for i, child in enumerate(node.children):
            if inner_pre and not pre and i == 0 and isinstance(child, str) and child.startswith("\n"):
                child = child[1:]
            label = None
            if number is not None and not isinstance(child, str) and child.tag == "li" and not child.hidden:
                label, number = number, number + 1
            if tag == "mfrac" and not isinstance(child, str) and any(not isinstance(x, str) for x in node.children[:i]):
                children.append(("enter", "/", inner_pre, None))
            children.append(("enter", child, inner_pre, label))
        if tag == "mtd":
            children = [("enter", " ", False, None), *children, ("enter", " ", False, None)]
        work.extend(reversed(children))
    return result[0].strip("\n")


def page_text(page: str | None) -> str:
    """The visible text of one page."""
    return render(build_tree((page or "").replace("\r\n", "\n").replace("\r", "\n").replace("\x00", "")))


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` without the markup column, with the visible text as ``out_col``.

    A column that already has that name is replaced.
    """
    keep = [c for c in pages.columns if c not in (html_col, out_col)]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 256, html_col, 2 << 20):
            texts = [page_text(p) for p in batch.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(texts, pa.string())],
                                             names=[*keep, out_col])

    schema = pages.select(*keep, F.lit("").alias(out_col)).schema
    return arrow_map(pages.select(*keep, html_col), run, schema)
