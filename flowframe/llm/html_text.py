"""Visible text of web pages, laid out as a reader sees it.

A tree builder reads the markup with its implied tags: an item ends an item, a block
ends a paragraph, a cell ends a cell, what is no metadata ends the head, and an end tag closes what is still open in it.
The renderer leaves out what a browser hides, puts blocks on lines of their own, a
blank line around paragraphs and the like, marks list items, keeps preformatted text
as it is and aligns the cells of a table in columns.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Generator, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.base import without

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes plaintext".split())
HIDDEN = set(
    "area base datalist head link meta noembed noframes noscript param rp script style template title iframe "
    "object video audio canvas annotation annotation-xml".split()
)
#: Kinds of input whose value is on view; one without a kind, or of an unknown one, is a text.
UNSHOWN = set("hidden password checkbox radio file range color image".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset menu xmp plaintext".split())
BLOCK = SPACED | set(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header "
    "hgroup html legend li listing main nav search section summary tbody td tfoot th thead tr".split()
)
#: A start tag closes the open elements on the right, no further up than the fences.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
} | {x: ({"tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}) for x in ("thead", "tbody", "tfoot")}
P_ENDS = (SPACED | BLOCK | {"hr"}) - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "legend"}
P_FENCES = {"td", "th", "caption", "button", "object", "table"}
#: What may stand in a head; anything else ends it, as its end tag may be left out.
METADATA = set("base basefont bgsound link meta noframes noscript script style template title".split())
#: Raw text that a browser shows.
SHOWN = {"xmp", "plaintext", "textarea"}
#: In drawings and formulas a tag may close itself; these end them, unless they stand in a part that holds HTML.
BREAKOUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
FOREIGN, HOLDS_HTML = {"svg", "math"}, set("foreignobject desc annotation-xml mi mo mn ms mtext".split())
#: What a drawing only defines or describes.
UNDRAWN = set("defs symbol clippath mask pattern marker desc metadata".split())
BLANK = " \t\n\r\f"

# A quote opens a value only right after '='; anywhere else it is a plain character, and '>' ends the tag.
_VALUED = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+"""
_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    rf"|<([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_VALUED})*+)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+))?+)?+""")
# A declaration reaches to the next semicolon that stands in no string and no brackets.
_DECLARATION = re.compile(r"""(?:[^;"'()\\]|\\.|"(?:[^"\\]|\\.)*+(?:"|\Z)|'(?:[^'\\]|\\.)*+(?:'|\Z)|\((?:[^()"']|"[^"]*+"?|'[^']*+'?)*+\)?|\))++""", re.DOTALL)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Kept(str):
    """An empty line of the page's own, which a list leaves in."""


KEPT = Kept()


def declared(style: str, name: str) -> str | None:
    """The value of a property in a style attribute: the last one counts, an important one before others."""
    value, important = None, False
    if name not in style.lower():
        return None
    for one in _DECLARATION.findall(_COMMENT.sub(" ", style)):
        key, colon, given = one.partition(":")
        if colon and key.strip().lower() == name:
            plain, mark, rest = given.strip().lower().partition("!")
            strong = mark == "!" and rest.strip() == "important"
            if (strong or not important) and plain.strip() and (not mark or strong):
                value, important = plain.strip(), strong
    return value


class Node:
    """An element; ``seen`` is its visibility, its parent's unless its style says otherwise."""

    __slots__ = ("tag", "attributes", "children", "seen")

    def __init__(self, tag: str, attributes: dict[str, str], seen: bool = True):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []
        told = declared(attributes["style"], "visibility") if "style" in attributes else None
        self.seen = {"visible": True, "hidden": False, "collapse": False}.get(told, seen)


def build(source: str) -> Node:
    """The tree of a page; markup that is broken off at the end stays out."""
    root = Node("", {})
    stack = [root]
    # Where each tag stands open on the stack, so that no search walks a deep one.
    opened: defaultdict[str, list[int]] = defaultdict(list)

    def push(node: Node) -> None:
        opened[node.tag].append(len(stack))
        stack.append(node)

    def cut(depth: int) -> None:
        while len(stack) > depth:
            opened[stack.pop().tag].pop()

    def deepest(tags: Iterable[str]) -> int:
        return max((opened[tag][-1] for tag in tags if opened[tag]), default=0)

    def close(tags: set[str], fences: set[str]) -> None:
        if not any(opened[tag] for tag in tags):
            return
        fence = deepest(fences)
        within = ((opened[tag], bisect_right(opened[tag], fence)) for tag in tags)
        first = min((depths[at] for depths, at in within if at < len(depths)), default=0)
        if first:
            cut(first)

    def text(data: str) -> None:
        data = html.unescape(data)
        if stack[-1].tag == "head" and data.strip(BLANK):
            cut(len(stack) - 1)
        if stack[-1].seen:
            stack[-1].children.append(data)

    at = 0
    while match := _MARKUP.search(source, at):
        if match.start() > at:
            text(source[at : match.start()])
        at = match.end()
        if match[2] and not match[4]:
            break
        if match[1]:
            tag = match[1].lower()
            fences = {"table"} if tag not in {"table", "html", "body"} else set()
            if opened[tag] and opened[tag][-1] > deepest(fences):
                cut(opened[tag][-1])
            if tag == "br":
                if stack[-1].tag == "head":
                    cut(len(stack) - 1)
                stack[-1].children.append(Node("br", {}))
        elif match[2]:
            tag = match[2].lower()
            if tag == "body":
                close({"head"}, {"template"})
            elif stack[-1].tag == "head" and tag not in METADATA:
                cut(len(stack) - 1)
            foreign = deepest(FOREIGN) > deepest(HOLDS_HTML)
            if foreign and tag in BREAKOUT:
                close(FOREIGN, HOLDS_HTML)
                foreign = False
            if tag in P_ENDS:
                close({"p"}, P_FENCES)
            if tag in ENDS:
                close(*ENDS[tag])
            if tag in {"td", "th"} and stack[-1].tag in {"table", "thead", "tbody", "tfoot"}:
                stack[-1].children.append(row := Node("tr", {}, stack[-1].seen))
                push(row)
            found = _ATTRIBUTE.findall(match[3]) if match[3].strip() else []
            node = Node(tag, {k.lower(): html.unescape(a or b or c) for k, a, b, c in reversed(found)}, stack[-1].seen)
            stack[-1].children.append(node)
            if (foreign or tag in FOREIGN) and self_closed(match[3]):
                continue
            if tag in RAW:
                end = None if tag == "plaintext" else re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, at)
                if tag in SHOWN and node.seen:
                    raw = source[at : end.start() if end else len(source)]
                    node.children.append(html.unescape(raw) if tag == "textarea" else raw)
                at = end.end() if end else len(source)
            elif tag not in VOID:
                push(node)
    broken = re.compile(r"<[a-zA-Z!/?]").search(source, at)
    text(source[at : broken.start() if broken else len(source)])
    return root


def self_closed(attributes: str) -> bool:
    """Whether a tag ends with a slash of its own, not with that of an unquoted value."""
    return attributes.endswith("/") and all(x.end() < len(attributes) for x in _ATTRIBUTE.finditer(attributes))


def hidden(node: Node) -> bool:
    a = node.attributes
    return (
        node.tag in HIDDEN
        or "hidden" in a
        or (node.tag == "dialog" and "open" not in a)
        or ("style" in a and declared(a["style"], "display") == "none")
    )


def shown(node: Node) -> list[Node | str]:
    """The children on view: of closed details the first summary."""
    if node.tag == "details" and "open" not in node.attributes:
        return [x for x in node.children if isinstance(x, Node) and x.tag == "summary"][:1]
    return node.children


def field(node: Node) -> str:
    """What a form field shows."""
    a = node.attributes
    if not node.seen:
        return ""
    if node.tag == "input":
        return "" if a.get("type", "").strip().lower() in UNSHOWN else a.get("value", "")
    options, work = [], [iter(node.children)]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
        elif isinstance(child, Node) and not hidden(child):
            if child.tag == "option":
                options.append(child)
            else:
                work.append(iter(child.children))
    listed = "multiple" in a or (a.get("size", "").strip().isdecimal() and int(a["size"]) > 1)
    if not listed:
        chosen = [x for x in options if "selected" in x.attributes]
        options = chosen[-1:] or [x for x in options if "disabled" not in x.attributes][:1]
    return " ".join(x.attributes.get("label") or "".join(_raw(x)).strip() for x in options)


class Page:
    """Lines in the making."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = False

    def text(self, data: str) -> None:
        core = _SPACE.sub(" ", data)
        if not core.strip(" "):
            self.space |= core != ""
            return
        if self.line and (self.space or core[0] == " ") and not self.line[-1].endswith((" ", "\n")):
            self.line.append(" ")
        self.line.append(core.strip(" "))
        self.space = core[-1] == " "

    def flush(self) -> None:
        if self.line:
            if self.gap and self.lines:
                self.lines.append("")
            self.lines.extend(x or KEPT for x in "".join(self.line).removesuffix("\n").split("\n"))
            self.line, self.gap = [], False
        self.space = False

    def block(self, lines: list[str], spaced: bool) -> None:
        self.flush()
        self.gap |= spaced
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.lines.extend(lines)
            self.gap = spaced


def _rows(part: Node) -> Iterator[tuple[Node, Node]]:
    """The rows with the part of the table that holds them."""
    for child in part.children:
        if isinstance(child, Node) and not hidden(child):
            if child.tag == "tr":
                yield part, child
            elif child.tag in {"thead", "tbody", "tfoot"}:
                yield from _rows(child)


def columns(line: str) -> int:
    """Places a line takes: wide characters two, marks and format characters none."""
    if line.isascii():
        return len(line)
    return sum(
        2 if unicodedata.east_asian_width(c) in "WF" else 0 if unicodedata.category(c) in ("Mn", "Me", "Cf") else 1 for c in line
    )


def padded(line: str, width: int) -> str:
    return line + " " * (width - columns(line))


def _span(cell: Node, name: str, most: int) -> int:
    """A span within the standard's bounds."""
    told = re.match(r"[ \t\n\r\f]*\+?([0-9]+)", cell.attributes.get(name, ""))
    if told is None:
        return 1
    digits = told[1].lstrip("0")
    return most if len(digits) > len(str(most)) else min(int(digits or 0), most)


#: A task yields the tasks whose lines it needs; ``run`` keeps them on a stack of its own,
#: so that no depth of nesting can overrun Python's.
Task = Generator["Task", list[str], list[str]]


def run(task: Task) -> list[str]:
    tasks, lines = [task], None
    while tasks:
        try:
            inner = tasks[-1].send(lines)
        except StopIteration as done:
            tasks.pop()
            lines = done.value
        else:
            tasks.append(inner)
            lines = None
    return lines


def _table(node: Node) -> Task:
    """Rows of cells in columns; a cell may have several lines, and one that spans others fills its first place."""
    head = []
    for child in node.children:
        if isinstance(child, Node) and child.tag == "caption" and not hidden(child):
            head += yield _lines(child)
    rows: list[list[list[str] | None]] = []
    part, held = None, {}
    for within, row in _rows(node):
        if within is not part:
            # A cell spans no further than its part of the table.
            part, held = within, {}
        cells: list[list[str] | None] = []
        begun = {}
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in {"td", "th"} and not hidden(cell):
                while len(cells) in held:
                    cells.append(None)
                wide, deep = _span(cell, "colspan", 1000) or 1, _span(cell, "rowspan", 65534) or 65534
                if deep > 1:
                    begun |= dict.fromkeys(range(len(cells), len(cells) + wide), deep - 1)
                cells.append((yield _lines(cell)))
                cells.extend([None] * (wide - 1))
        cells.extend([None] * (max(held, default=-1) + 1 - len(cells)))
        held = {k: left - 1 for k, left in held.items() if left > 1} | begun
        if any(cells):
            rows.append(cells)
    # A column in which no cell begins takes no room.
    used = sorted({k for row in rows for k, cell in enumerate(row) if cell is not None})
    rows = [[row[k] or [] for k in used if k < len(row)] for row in rows]
    widths = [max((columns(x) for r in rows if k < len(r) for x in r[k]), default=0) for k in range(len(used))]
    out = head
    for row in rows:
        for k in range(max(map(len, row))):
            line = " | ".join(padded(cell[k] if k < len(cell) else "", width) for cell, width in zip(row, widths)).rstrip()
            out.append(line or (KEPT if any(k < len(cell) and cell[k] is KEPT for cell in row) else line))
    return (yield _lines(_group([*_loose(node)]))) + out


def _loose(node: Node) -> Iterator[Node | str]:
    """What stands in a table outside its cells; a browser shows it before the table."""
    for child in node.children:
        if isinstance(child, Node) and child.tag in {"tr", "thead", "tbody", "tfoot"}:
            if not hidden(child):
                yield from _loose(child)
        elif isinstance(child, str) or child.tag not in {"td", "th", "caption"}:
            yield child


def _group(children: list) -> Node:
    node = Node("", {})
    node.children = children
    return node


def _lines(node: Node) -> Task:
    page = Page()
    work: list = [iter(node.children)]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
            if work and callable(work[-1]):
                work.pop()()
            continue
        if isinstance(child, str):
            page.text(child)
        elif hidden(child):
            continue
        elif child.tag == "br":
            page.line.append("\n")
            page.space = False
        elif child.tag == "hr":
            page.block(["---"] if child.seen else [], False)
        elif child.tag in {"input", "select"}:
            page.text(f" {told} " if (told := field(child)) else " ")
        elif child.tag in {"pre", "listing", "xmp", "plaintext", "textarea"}:
            page.block([x or KEPT for x in "".join(_raw(child)).strip("\r\n").splitlines()], child.tag != "textarea")
        elif child.tag == "svg":
            for piece in _drawn(child):
                page.block((yield _lines(piece)), False)
        elif child.tag == "table":
            page.block((yield _table(child)), True)
        elif child.tag in {"ul", "ol", "menu", "dir"}:
            page.block((yield _list(child)), True)
        elif child.tag == "blockquote":
            quoted = yield _lines(child)
            page.block(["  " + x if x else x for x in quoted], True)
        elif child.tag in BLOCK:
            spaced = child.tag in SPACED
            page.block([], spaced)
            work.append(lambda spaced=spaced: page.block([], spaced))
            work.append(iter(shown(child)))
        else:
            if child.tag in {"td", "th"}:
                page.text(" ")
            work.append(iter(child.children))
    page.flush()
    return page.lines


# The numerals of list marks.
ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


def numeral(number: int, kind: str) -> str:
    """A list number as letters (a, A), in Roman numerals (i, I) or in digits, as beyond what these can tell."""
    text = ""
    if kind in {"a", "A"} and number > 0:
        while number:
            number, rest = divmod(number - 1, 26)
            text = chr(97 + rest) + text
    elif kind in {"i", "I"} and 0 < number < 4000:
        for value, letters in ROMAN:
            text += letters * (number // value)
            number %= value
    else:
        return str(number)
    return text if kind.islower() else text.upper()


def _whole(text: str | None) -> int | None:
    told = re.match(r"[ \t\n\r\f]*([+-]?[0-9]{1,9})", text or "")
    return int(told[1]) if told else None


def _list(node: Node) -> Task:
    items = sum(isinstance(x, Node) and x.tag == "li" and not hidden(x) for x in node.children)
    back = node.tag == "ol" and "reversed" in node.attributes
    start = _whole(node.attributes.get("start"))
    number = start if start is not None else items if back else 1
    out: list[str] = []
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li" and not hidden(child):
            told = _whole(child.attributes.get("value"))
            number = number if told is None else told
            kind = child.attributes.get("type", node.attributes.get("type", "1")).strip()
            mark = f"{numeral(number, kind)}. " if node.tag == "ol" else "- "
            number += -1 if back else 1
            lines = [x for x in (yield _lines(child)) if x or x is KEPT]
            if not child.seen:
                # The mark goes with its item; what is on view within it keeps its place.
                out.extend(x if x is KEPT else " " * len(mark) + x for x in lines)
                continue
            lines = lines or [""]
            out.append((mark + lines[0]).rstrip())
            out.extend(x if x is KEPT else " " * len(mark) + x for x in lines[1:])
        else:
            loose = yield _lines(_group([child]))
            out.extend(x if x is KEPT else "  " + x for x in loose if x or x is KEPT)
    return out


def _raw(node: Node) -> Iterator[str]:
    work = [iter(node.children)]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
        elif isinstance(child, str):
            yield child
        elif child.tag == "br":
            yield "\n"
        elif child.tag in {"input", "select"}:
            yield "" if hidden(child) else field(child)
        elif not hidden(child):
            work.append(iter(shown(child) if child.tag != "svg" else _drawn(child)))


def _drawn(node: Node) -> list[Node]:
    """The texts of a drawing, and its parts that hold HTML."""
    found, work = [], [iter(node.children)]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
        elif isinstance(child, Node) and not hidden(child) and child.tag not in UNDRAWN:
            if child.tag in {"text", "foreignobject"}:
                found.append(child)
            else:
                work.append(iter(child.children))
    return found


def page_text(source: str | None) -> str:
    """All visible text of a page."""
    lines = run(_lines(build(source or "")))
    return "\n".join(line.rstrip() for line in lines).strip("\n")


def html_text(pages: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    """All rows with the visible text of their page.

    A null or empty page, or one without markup, gives its plain text (null: empty).
    Repeated rows each get theirs. A column named like the result gives way to it,
    and the markup is left out. Style sheets and scripts do not run: only attributes
    and the tags' own rules hide text. Media give none; a field gives the value it shows, a
    choice the chosen option (a list box all), a formula its symbols in order, and closed
    details their summary. The items of a list stand without the gaps around their paragraphs. Memory follows the largest page, and with each level of
    nested lists, quotes and tables every line within gets longer: the text of a page that
    opens thousands of them grows with the square of their number.
    """
    kept = without(pages, source, out)
    columns = kept.columns
    work = pages.select(*(F.col(f"`{c}`") for c in columns), F.col(f"`{source}`").cast("binary").alias("__llm_source"))
    schema = kept.withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [page_text((x.as_py() or b"").decode("utf-8", "replace")) for x in part.column(len(columns))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*columns, out])

    return work.mapInArrow(run, schema)
