"""HTML extraction by layout: a tree builder with implied tags, then a renderer of all visible text.

Blocks stand on lines of their own, paragraphs, headings and tables apart by a blank line; list items carry
their bullet or number and are indented by nesting; table cells stand in aligned columns, cells of several rows
or columns keep their place, and lines of a cell beyond COLUMN characters are wrapped; preformatted
text keeps its lines. Labels of a drawing stand on lines of their own; of a select's options those that the page
shows are kept. Invisible elements (by name, ``hidden``, an inline style, a dialog that isn't open, the values of
fields that don't show them) give nothing; what a reader can unfold (details) is kept. Elements nest to any depth:
the builder and the renderer keep stacks of their own; past 40 levels items, quotes and tables stand in no further.
"""

from __future__ import annotations

import re
from bisect import bisect_right as bisect
from collections.abc import Generator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, read

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NOT_SHOWN = frozenset("head script style title template noscript iframe noembed noframes datalist audio video canvas meta link base".split())
#: drawings and formulas: an element may close itself, and these in it aren't shown
FOREIGN = {"svg": frozenset("defs title desc metadata".split()), "math": frozenset("annotation annotation-xml".split())}
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset".split())
BLOCK = SPACED | frozenset("html body div section article aside header footer nav main address form li dt dd tr td th caption thead tbody tfoot hr figcaption details summary center menu legend option".split())
#: a start tag of the key closes an open element of these names, up to a barrier
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
P_ENDS = BLOCK - {"html", "body", "li", "dt", "dd", "tr", "td", "th", "caption", "thead", "tbody", "tfoot", "option", "legend"}
TABLE_TAGS = frozenset("table tr tbody thead tfoot body html".split())
#: elements that stand in, by what counts as a level of theirs
LEVELS = {"table": ("table",)} | dict.fromkeys(("li", "dd", "blockquote"), ("li", "dd", "blockquote"))
#: inputs whose value is seen
VALUED = frozenset(("", *"text search email url tel number date month week time datetime-local button submit reset".split()))
COLUMN = 80
#: Items, quotes and tables beyond NESTED levels of their kind are marked so: they stand in no further, or text would grow with its depth.
DEEP, NESTED = "\0deep", 40
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")
_COMMENT, _VALUE = re.compile(r"/\*.*?(?:\*/|\Z)", re.S), re.compile(r"([a-z-]+)\s*(!\s*important)?\Z")
#: Shown without any text in them.
SEEN = frozenset("img input select hr".split())
#: In these a form's tags are dropped, so that they split no row.
ROWS = frozenset("table thead tbody tfoot tr".split())
_BLANK = re.compile(r"[ \t\n\r\f]+")
Node = tuple  # (tag, attributes, children); text is a str


class Open:
    """The stack of open elements, and where in it each name stands."""

    def __init__(self, root: Node) -> None:
        self.stack, self.where = [root], {}

    def push(self, node: Node) -> None:
        self.where.setdefault(node[0], []).append(len(self.stack))
        self.stack.append(node)

    def last(self, *names: str) -> int:
        """The highest place of one of the names, 0 if none is open."""
        return max((self.where[n][-1] for n in names if self.where.get(n)), default=0)

    def above(self, low: int, names) -> int:
        """The lowest place over ``low`` of one of the names, 0 if there is none."""
        found = (at[k] for n in names if (at := self.where.get(n)) and (k := bisect(at, low)) < len(at))
        return min(found, default=0)

    def count(self, *names: str) -> int:
        return sum(len(self.where.get(n, ())) for n in names)

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            self.where[self.stack.pop()[0]].pop()


def parse(html: str) -> Node:
    """The tree under a root of tag ''. Every piece of text is in it; only a tag that the page's end cuts off isn't.

    A quote that is never closed ends with its tag.
    """
    root: Node = ("", {}, [])
    opened = Open(root)
    stack = opened.stack
    at = 0

    def text(s: str) -> None:
        if s:
            if stack[-1][0] == "head" and s.strip(" \t\n\r\f"):
                opened.cut(len(stack) - 1)  # a head holds no text: the body has begun
            stack[-1][2].append(unescape(s) if "&" in s else s)

    while True:
        m = _TOKEN.search(html, at)
        if not m:
            text(html[at:])
            if _VEIL.search(html):
                veil(root)
            return root
        text(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            k = opened.last(tag)
            if k and (tag in TABLE_TAGS or k >= opened.last("table", "td", "th")):
                opened.cut(k)  # else a stray end tag: one in a cell does not close what is around the table
            continue
        if tag in CLOSES:
            names, barrier = CLOSES[tag]
            if k := opened.above(opened.last(*barrier), names):
                opened.cut(k)
        if tag in P_ENDS or tag in ("li", "dt", "dd"):
            k = opened.last("p")
            if k > opened.last("table", "td", "th", "li", "button", "object"):
                opened.cut(k)
        if tag == "form" and stack[-1][0] in ROWS or tag == "head" and stack[-1][0] not in ("", "html") or tag == "html" and stack[-1][0] == "head":
            continue
        if stack[-1][0] == "head" and tag not in NOT_SHOWN:
            opened.cut(len(stack) - 1)
        attrs = {a.lower(): b or c or d for a, b, c, d in _ATTR.findall(m[3])} if m[3].strip(" /\n\t\r") else {}
        node: Node = (tag, attrs, [])
        around = opened.last(*FOREIGN)
        if around and tag in FOREIGN[stack[around][0]]:
            attrs["hidden"] = ""
        if tag in LEVELS and opened.count(*LEVELS[tag]) >= NESTED:
            attrs[DEEP] = ""
        stack[-1][2].append(node)
        if tag in VOID or (around or tag in FOREIGN) and m[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            stop = end.start() if end else len(html)
            if stop > at:
                node[2].append(unescape(html[at:stop]) if tag in ("textarea", "title") else html[at:stop])
            at = end.end() if end else len(html)
        else:
            opened.push(node)


def declared(style: str, name: str) -> str | None:
    """The value of a property in an inline style: of several the last one, one marked important before others."""
    value, strong = None, False
    for part in _COMMENT.sub("", style).lower().split(";"):
        key, _, v = part.partition(":")
        if key.strip() == name and (m := _VALUE.match(v.strip())) and bool(m[2]) >= strong:
            value, strong = m[1], bool(m[2])
    return value


def shown(node: Node) -> bool:
    tag, attrs, _ = node
    return not (tag in NOT_SHOWN or "hidden" in attrs or tag == "dialog" and "open" not in attrs or (s := attrs.get("style")) and declared(s, "display") == "none")


_VEIL = re.compile(r"visibility", re.I)


def veil(root: Node) -> None:
    """Takes out what ``visibility`` hides; elements in it stay, as what they hold may be visible again."""
    todo = [(root, False)]
    while todo:
        (_, attrs, children), hidden = todo.pop()
        value = declared(attrs["style"], "visibility") if attrs.get("style") else None
        hidden = value != "visible" if value in ("visible", "hidden", "collapse") else hidden
        inner = [c for c in children if not isinstance(c, str)]
        if hidden:
            children[:] = [c for c in inner if c[0] not in SEEN or "visible" == declared(c[1].get("style", ""), "visibility")]
        todo += [(c, hidden) for c in inner]


# The functions that render nest as elements do. Each is a generator that yields the call it needs and is sent its
# result, and run() keeps the stack.


def run(call: Generator):
    """The result of a rendering call."""
    stack, value = [call], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def options(node: Node) -> list[Node]:
    """The options of a select that a page shows: all of a list, else the one selected, or the first."""
    found: list[Node] = []
    todo = node[2][::-1]
    while todo:
        c = todo.pop()
        if not isinstance(c, str) and shown(c):
            if c[0] == "option":
                found.append(c)
            else:
                todo += c[2][::-1]
    size = (node[1].get("size") or "").strip()
    if "multiple" in node[1] or re.fullmatch(r"[0-9]{1,9}", size) and int(size) > 1:
        return found
    chosen = [c for c in found if "selected" in c[1]]
    ready = [c for c in found if "disabled" not in c[1]]
    return chosen[-1:] or ready[:1] or found[:1]


def option_texts(node: Node) -> Generator:
    out = []
    for c in options(node):
        lines = yield flow(c[2])
        out.append(" ".join(lines) or c[1].get("label", ""))
    return out


def flow(nodes: list) -> Generator:
    """The lines of a run of nodes."""
    lines: list[str] = []
    inline: list[str] = []
    gap = 0

    def add(new: list[str], space: int) -> None:
        nonlocal gap, lines
        if new:
            if lines and max(gap, space):
                lines.append("")
            if lines:
                lines.extend(new)
            else:
                lines = new  # of elements nested alone nothing is copied
            gap = space

    def flush() -> None:
        if inline:
            whole = "".join(inline)
            inline.clear()
            parts = [_BLANK.sub(" ", x).strip(" ") for x in whole.split("\0")]
            if parts and not parts[-1]:
                parts.pop()
            if any(parts):
                add(parts, 0)

    todo = nodes[::-1]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            inline.append(node.replace("\0", ""))
            continue
        if not shown(node):
            continue
        tag, attrs, children = node
        if tag == "br":
            inline.append("\0")
        elif tag == "img":
            inline.append(attrs.get("alt", "").replace("\0", ""))
        elif tag == "input":
            if attrs.get("type", "").strip().lower() in VALUED:
                inline.append(attrs.get("value", "").replace("\0", ""))
        elif tag == "select":
            texts = yield option_texts(node)
            inline.append("\0".join(x.replace("\0", "") for x in texts))
        elif tag in BLOCK or tag == "text":
            flush()
            new = yield block(node)
            add(new, 1 if tag in SPACED else 0)
        elif tag != "wbr":
            todo += children[::-1]
    flush()
    return lines


def block(node: Node) -> Generator:
    tag, attrs, children = node
    if tag in ("ul", "ol", "menu"):
        return (yield items(node))
    if tag == "table":
        return (yield table(node))
    if tag == "hr":
        return ["---"]
    if tag == "pre":
        whole = yield raw_text(node)
        return whole.strip("\n").split("\n")
    lines = yield flow(children)
    if tag == "li":
        return [*(f"- {x}" for x in lines[:1]), *lines[1:]] if DEEP in attrs else bulleted(lines, "- ")
    if tag in ("blockquote", "dd"):
        return lines if DEEP in attrs else ["    " + x if x else x for x in lines]
    return lines


def raw_text(node: Node) -> Generator:
    """Preformatted text as it stands; blocks in it begin and end lines, lists and tables are laid out."""
    out, todo, edge = [], [node], False

    def add(s: str) -> None:
        nonlocal edge
        if s:
            if edge and out and not out[-1].endswith("\n") and not s.startswith("\n"):
                out.append("\n")
            edge = False
            out.append(s)

    while todo:
        n = todo.pop()
        if n is None:
            edge = True
        elif isinstance(n, str):
            add(n)
        elif shown(n):
            if n[0] == "select":
                texts = yield option_texts(n)
                add("\n".join(texts))
            elif n[0] == "br":
                out.append("\n")
                edge = False
            elif n[0] in ("img", "input", "hr"):
                lines = yield flow([n])
                edge = edge or n[0] == "hr"
                add("\n".join(lines))
                edge = edge or n[0] == "hr"
            elif n[0] in ("ul", "ol", "menu", "table"):
                lines = yield block(kept(n))
                edge = True
                add("\n".join(lines).replace("\1", " "))
                edge = True
            else:
                if n[0] in BLOCK and n is not node:
                    edge = True
                    todo.append(None)
                todo += n[2][::-1]
    return "".join(out)


def kept(node: Node) -> Node:
    """A copy whose blanks and line ends survive being laid out: blanks as the character 1, line ends as br."""
    copy: Node = (node[0], node[1], [])
    todo = [(node, copy)]
    while todo:
        (_, _, children), (tag, _, new) = todo.pop()
        for c in children:
            if not isinstance(c, str):
                new.append((c[0], c[1], []))
                todo.append((c, new[-1]))
            elif tag in ("table", "thead", "tbody", "tfoot", "tr", "ul", "ol", "menu") and not c.strip():
                new.append(c)
            else:
                for k, line in enumerate(c.split("\n")):
                    new += [("br", {}, [])] * (k > 0) + [line.replace(" ", "\1").replace("\t", "\1" * 4)]
    return copy


def bulleted(lines: list[str], mark: str) -> list[str]:
    return [(mark if not k else " " * len(mark)) + x if x or not k else x for k, x in enumerate(lines)]


def numeral(n: int, kind: str) -> str:
    """An item's number as its list counts: in digits, letters or Roman numerals."""
    if kind in ("a", "A") and n > 0:
        out = ""
        while n:
            n, k = divmod(n - 1, 26)
            out = chr(ord(kind) + k) + out
        return out
    if kind in ("i", "I") and 0 < n < 4000:
        out = ""
        for one, five, ten, p in (("m", "", "", 1000), ("c", "d", "m", 100), ("x", "l", "c", 10), ("i", "v", "x", 1)):
            k, n = divmod(n, p)
            out += one + ten if k == 9 else one + five if k == 4 else five * (k > 4) + one * (k % 5)
        return out.upper() if kind == "I" else out
    return str(n)


def integer(attrs: dict, name: str) -> int | None:
    at = (attrs.get(name) or "").strip()
    return int(at) if re.fullmatch(r"[+-]?[0-9]{1,9}", at) else None


def items(node: Node) -> Generator:
    """A list's lines; what is not in an item stands unmarked between them."""
    out: list[str] = []
    step = -1 if "reversed" in node[1] else 1
    number = integer(node[1], "start")
    if number is None:
        number = 1 if step > 0 else sum(not isinstance(c, str) and c[0] == "li" and shown(c) for c in node[2])
    other: list = []
    for c in [*node[2], None]:
        if c is not None and (isinstance(c, str) or c[0] != "li"):
            other.append(c)
            continue
        if other:
            out += yield flow(other)
            other = []
        if c is not None and shown(c):
            number = number if (own := integer(c[1], "value")) is None else own
            lines = yield flow(c[2])
            if lines:
                mark = f"{numeral(number, node[1].get('type', '').strip())}. " if node[0] == "ol" else "- "
                out += [mark + lines[0], *lines[1:]] if DEEP in c[1] else bulleted(lines, mark)
            number += step
    return out


def span_of(cell: Node, name: str) -> int:
    """Rows or columns of a cell; 0 for all rows that follow."""
    n = (cell[1].get(name) or "").strip()
    if not re.fullmatch(r"[0-9]{1,9}", n):
        return 1
    return int(n) or (0 if name == "rowspan" else 1)


def wrapped(lines: list[str]) -> list[str]:
    """Lines cut at blanks so that none is longer than COLUMN, but for single words."""
    out = []
    for x in lines:
        while len(x) > COLUMN:
            at = x.rfind(" ", 1, COLUMN + 1)
            at = at if x[:at].strip() else x.find(" ", COLUMN)
            if at < 0:
                break
            out.append(x[:at].rstrip())
            x = x[at + 1 :]
        out.append(x)
    return out


def table(node: Node) -> Generator:
    """Rows of cells in columns; captions and stray text stand before.

    A cell stands in the first column that no cell of an earlier row reaches into. Columns in which no cell begins
    take no room, and one is as wide as the widest line of its cells of a single column, up to COLUMN; a line that is
    wider moves what follows on it.
    """
    before: list[str] = []
    rows: list[dict[int, tuple[list[str], bool]]] = []
    loose: list = []
    held: list[list] = []  # first column, end, rows left (None: all) of cells that reach into the rows to come

    def put(row: list[tuple[list[str], int, int]]) -> None:
        nonlocal held
        placed, at, new = {}, 0, []
        taken = sorted((a, b) for a, b, _ in held)
        k = 0
        for lines, wide, high in row:
            while k < len(taken) and taken[k][0] <= at:
                at = max(at, taken[k][1])
                k += 1
            placed[at] = lines, wide == 1
            if high != 1:
                new.append([at, at + wide, high - 1 if high else None])
            at += wide
        held = [[a, b, n if n is None else n - 1] for a, b, n in held if n is None or n > 1] + new
        rows.append(placed)

    groups = [iter(node[2])]
    while groups:
        c = next(groups[-1], None)
        if c is None:
            groups.pop()
            held = []  # a cell ends with its group of rows
        elif isinstance(c, str):
            if c.strip():
                loose.append(c)
        elif not shown(c):
            continue
        elif c[0] in ("thead", "tbody", "tfoot"):
            held = []
            groups.append(iter(c[2]))
        elif c[0] == "tr":
            row = []
            for d in c[2]:
                if not isinstance(d, str) and d[0] in ("td", "th"):
                    if shown(d):
                        lines = yield flow(d[2])
                        row.append((wrapped(lines), span_of(d, "colspan"), span_of(d, "rowspan")))
                elif not isinstance(d, str) or d.strip():
                    loose.append(d)
            put(row)
        elif c[0] in ("td", "th"):
            lines = yield flow(c[2])
            put([(wrapped(lines), 1, 1)])
        elif c[0] == "caption":
            before += yield flow(c[2])
        else:
            loose.append(c)
    width: dict[int, int] = {}
    for row in rows:
        for at, (lines, single) in row.items():
            width[at] = max(width.get(at, 0), min(COLUMN, max(map(len, lines), default=0)) if single else 0)
    offset, x = {}, 0
    for at in sorted(width):
        offset[at] = x
        x += width[at] + 2
    stray = yield flow(loose)
    out = stray + before
    for row in rows:
        if DEEP in node[1]:
            out += [line for lines, _ in row.values() for line in lines]
            continue
        cells = [(offset[at], lines) for at, (lines, _) in row.items()]
        for k in range(max((len(lines) for _, lines in cells), default=0)):
            line = ""
            for at, lines in cells:
                if k < len(lines) and lines[k]:
                    line = line.ljust(at) if len(line) <= at - 2 or not line else line + "  "
                    line += lines[k]
            out.append(line.rstrip())
    return out


def render(html: str) -> str:
    return "\n".join(run(flow(parse(html)[2])))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id and text for every row of pages.

    Null and empty pages give an empty text; broken mark-up loses no visible text, but for a last tag or comment that
    isn't closed; repeated rows get equal rows and ids may be null; an empty table gives no rows; other columns
    are ignored.
    """
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), F.coalesce(pages[html_col], F.lit("")).alias("html"))

    def make():
        return lambda b: (b.column(0), pa.array([render(x) for x in b.column(1).to_pylist()], pa.string()))

    return map_batches(rows, make, "page_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
