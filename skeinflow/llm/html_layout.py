"""All visible text of web pages, laid out as a browser would stack it.

A tree is built with implied end tags (paragraphs, list items, table parts, options), stray end tags
ignored and everything closed at the end.  Visibility rules drop what is never shown: head matter, scripts,
styles, templates, elements with ``hidden`` or an inline ``display: none`` / ``visibility: hidden``, and
the body of closed ``details``.  Rendering keeps block spacing, list markers and nesting,
preformatted text, and pads table cells into columns.

Time and output are linear in the page.  The scanner goes forward once; elements in scope are found from one stack of
places per tag; nothing recurses.  Cells are padded to ``WIDE`` characters at most and lines indented by ``DEEP`` at
most, so a page's text is at most its own characters and that padding for each cell and line, never cut.
A table within a cell is one line of the cell.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: Padding of a table cell and indentation of a line, at most.
WIDE, DEEP = 40, 40

#: An attribute: a quote delimits only right after the '=' of a name and if it is closed; any other quote is an ordinary character.
_NAME, _VALUE = r"""[^\s/>][^\s/>=]*+""", r"""\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+)"""
_ATTR = re.compile(rf"""({_NAME})(?>{_VALUE})?+""")
_STEP = re.compile(rf"""[\s/]++|{_NAME}(?:\s*+=\s*+(?P<quote>["'])?)?+""")
_PLAIN = re.compile(r"""[^\s>]*+""")
_TAG_NAME = re.compile(r"""/?[a-zA-Z][^\s/>]*+""")
_COMMENT_END = re.compile(r"--!?>")
_HIDING = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)")
_WATCHED = re.compile(r"(?i)hidden|style|type|value|start|colspan|open")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("head script style template noscript iframe noembed noframes object embed audio video canvas svg math title meta link datalist map col colgroup rp".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre xmp figure form fieldset hr".split())
BLOCK = SPACED | frozenset("html body div section article header footer nav main aside address li dt dd tr caption thead tbody tfoot td th figcaption details summary legend option optgroup center menu dir".split())
#: Start tags that end an open paragraph.
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dt dd xmp".split())
#: For a start tag: open elements that it ends, and those that stop the search for them.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"body"}),
}
#: An end tag looks for its element no farther than these.
_SCOPE = frozenset("table td th caption html body".split())


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(raw: str) -> dict[str, str] | None:
    if not raw or not _WATCHED.search(raw):
        return None
    return {k.lower(): html.unescape(v[1:-1] if v[:1] in "\"'" else v) for k, v in _ATTR.findall(raw)}


class _Scanner:
    """Finds the ends of tags, going forward only."""

    def __init__(self, page: str):
        self.page = page
        self.gt = -1  # a '>' at or after the last place asked for; len(page) if there is none
        self.gone: set[str] = set()  # quotes that do not come again
        self.loose = False

    def next_gt(self, at: int) -> int:
        if self.gt < at:
            found = self.page.find(">", at)
            self.gt = found if found >= 0 else len(self.page)
        return self.gt

    def tag_end(self, at: int) -> int:
        """Place of the '>' that ends a tag whose attributes begin at ``at``; the page's length if it never ends.

        Should quotes hide every further '>', that tag and all after it end at the next '>', quoted or not.
        """
        page, gt = self.page, self.next_gt(at)
        if gt == len(page) or self.loose or page.find('"', at, gt) < 0 and page.find("'", at, gt) < 0:
            return gt
        while at < len(page) and page[at] != ">":
            m = _STEP.match(page, at)
            at, quote = m.end(), m["quote"]
            if quote:
                close = -1 if quote in self.gone else page.find(quote, at)
                if close < 0:
                    self.gone.add(quote)
                at = close + 1 if close >= 0 else _PLAIN.match(page, at - 1).end()
            elif page[at - 1] == "=" or m.group().rstrip().endswith("="):
                at = _PLAIN.match(page, at).end()
        if at >= len(page):
            self.loose = True
            return gt
        return at


def parse(page: str) -> Node:
    """The tree of a page; its root has no tag."""
    root = Node("")
    open_nodes = [root]
    places: dict[str, list[int]] = {}
    at, n = 0, len(page)
    scan = _Scanner(page)

    def close_to(depth: int) -> None:
        for x in open_nodes[depth:]:
            places[x.tag].pop()
        del open_nodes[depth:]

    def find(tags: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> int:
        """Place of the innermost open element of ``tags``, 0 if one of ``stops`` comes before it."""
        k = max((places[t][-1] for t in tags if places.get(t)), default=0)
        return k if k and all(places[t][-1] < k for t in stops if places.get(t)) else 0

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            open_nodes[-1].children.append(page[at:lt])
        if lt >= n:
            break
        if page.startswith("<!--", lt):
            if page.startswith((">", "->"), lt + 4):
                at = page.index(">", lt) + 1
            else:
                m = _COMMENT_END.search(page, lt + 4)
                at = m.end() if m else n
            continue
        if page.startswith(("<!", "<?"), lt):
            at = scan.next_gt(lt) + 1
            continue
        m = _TAG_NAME.match(page, lt + 1)
        end = scan.tag_end(m.end()) if m else n
        if end >= n:  # no tag: the '<' is text
            open_nodes[-1].children.append("<")
            at = lt + 1
            continue
        name, raw, at = m.group().lower(), page[m.end() : end], end + 1
        if name[0] == "/":
            name = name[1:]
            if name == "br":
                open_nodes[-1].children.append(Node("br"))
            elif places.get(name):
                k = find({name}, _SCOPE - {name} if name not in ("table", "body", "html") else frozenset({"html"}) - {name})
                if k:
                    close_to(k)
            continue
        if places.get("p") and name in _ENDS_P:
            k = find({"p"}, frozenset({"table", "td", "th", "button", "caption"}))
            if k:
                close_to(k)
        rule = _IMPLIED.get(name)
        if rule:
            while k := find(*rule):
                close_to(k)
        node = Node(name, _attributes(raw))
        open_nodes[-1].children.append(node)
        if name in VOID or raw.endswith("/") and name not in BLOCK and name not in RAW:
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if name in ("textarea", "xmp"):
                body = page[at : close.start() if close else n]
                node.children.append(html.escape(body, quote=False) if name == "xmp" else body)  # xmp shows references as written
            at = close.end() if close else n
            continue
        places.setdefault(name, []).append(len(open_nodes))
        open_nodes.append(node)
    return root


def hidden(node: Node) -> bool:
    if node.tag in NEVER:
        return True
    a = node.attrs
    if not a:
        return False
    return "hidden" in a or bool(_HIDING.search(a.get("style", ""))) or node.tag == "input" and a.get("type", "").lower() not in ("submit", "button", "reset", "text", "")


class _Canvas:
    """Lines with pending blank lines, an indent and a marker for the next line."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.blank = False
        self.indent = 0
        self.marker = ""

    def text(self, s: str) -> None:
        words = s.split()
        if not words:
            self.space = self.space or bool(s)
            return
        if self.parts and (self.space or s[0].isspace()):
            self.parts.append(" ")
        self.parts.append(" ".join(words))
        self.space = s[-1].isspace()

    def pre(self, s: str) -> None:
        for k, line in enumerate(s.split("\n")):
            if k:
                self.feed(True)
            if line:
                self.parts.append(line.expandtabs(8))

    def feed(self, force: bool = False) -> None:
        """End the line, if it has text or is forced."""
        if self.parts or force or self.marker:
            line = "".join(self.parts)
            if self.lines and self.blank and self.lines[-1]:
                self.lines.append("")
            pad = " " * min(DEEP, max(0, self.indent - 2) if self.marker else self.indent)
            self.lines.append((pad + self.marker + line).rstrip())
            self.parts, self.marker, self.blank = [], "", False
        self.space = False

    def gap(self) -> None:
        self.feed()
        self.blank = True

    def result(self) -> str:
        self.feed()
        return "\n".join(self.lines).strip("\n")


class _Grid:
    def __init__(self):
        self.rows: list[list[tuple[str, int]]] = []

    def lines(self) -> list[str]:
        """Cells padded to their columns, up to WIDE; a cell over several columns takes their width together."""
        width: dict[int, int] = {}
        for row in self.rows:
            c = 0
            for text, span in row:
                if span == 1:
                    width[c] = max(width.get(c, 0), len(text))
                c += span
        # width of the columns before each, with the gaps between them; columns without a cell of their own have none
        columns = sorted(width)
        before = [0]
        for c in columns:
            before.append(before[-1] + width[c] + 2)
        out = []
        for row in self.rows:
            c, line = 0, []
            for text, span in row:
                own = width.get(c, 0) if span == 1 else max(0, before[bisect_left(columns, c + span)] - before[bisect_left(columns, c)] - 2)
                line.append(text.ljust(own) if own <= WIDE else text)
                c += span
            out.append("  ".join(line).rstrip())
        return [x for x in out if x]


def render(root: Node) -> str:
    """Visible text of a tree."""
    canvas = _Canvas()
    canvases, grids, lists = [canvas], [], []
    cell: Node | None = None  # the outermost open table cell
    preformatted = 0
    stack: list[tuple[Node | str, bool]] = [(x, False) for x in reversed(root.children)]
    while stack:
        node, leaving = stack.pop()
        if isinstance(node, str):
            s = html.unescape(node) if "&" in node else node
            if preformatted:
                canvas.pre(s)
            elif not (grids and grids[-1][1] is canvas):  # text between the parts of a table is not shown in it
                canvas.text(s)
            elif not s.isspace():
                canvas.text(s)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th") and len(canvases) > 1 and node is cell:
                text = " ".join(canvas.result().split())
                canvases.pop()
                canvas, cell = canvases[-1], None
                if not grids[-1][0].rows:
                    grids[-1][0].rows.append([])
                grids[-1][0].rows[-1].append((text, _whole((node.attrs or {}).get("colspan"), 1)))
                continue
            if tag == "table" and cell is None:
                grid, _ = grids.pop()
                for line in grid.lines():
                    canvas.feed()
                    canvas.parts.append(line)
                canvas.gap()
                continue
            if tag in ("pre", "xmp"):
                preformatted -= 1
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                canvas.feed()
                canvas.indent -= 2
            elif tag in ("blockquote", "dd"):
                canvas.feed()
                canvas.indent -= 2
            elif tag == "q":
                canvas.text("”")
            if tag in SPACED and not ((tag in ("ul", "ol")) and lists):
                canvas.gap()
            elif tag in BLOCK:
                canvas.feed()
            continue
        if hidden(node):
            continue
        if tag == "br":
            canvas.feed(True) if canvas.parts or preformatted else canvas.feed()
            continue
        if tag == "wbr" or tag == "img":
            continue
        if tag == "hr":
            canvas.gap()
            continue
        if tag == "input":
            canvas.text((node.attrs or {}).get("value", ""))
            continue
        if tag in ("td", "th") and grids and cell is None:
            canvas, cell = _Canvas(), node
            canvases.append(canvas)
        elif tag == "table" and cell is None:
            canvas.gap()
            grids.append((_Grid(), canvas))
        elif tag == "tr" and grids and cell is None:
            grids[-1][0].rows.append([])
        else:
            if tag in SPACED and not (tag in ("ul", "ol") and lists):
                canvas.gap()
            elif tag in BLOCK:
                canvas.feed()
            if tag in ("pre", "xmp"):
                preformatted += 1
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.append([tag, _whole((node.attrs or {}).get("start"), 1)])
                canvas.indent += 2
            elif tag == "li":
                if lists and lists[-1][0] == "ol":
                    canvas.marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                else:
                    canvas.marker = "- "
            elif tag in ("blockquote", "dd"):
                canvas.indent += 2
            elif tag == "q":
                canvas.text("“")
        stack.append((node, True))
        children = node.children
        if tag == "details" and "open" not in (node.attrs or {}):
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
        stack.extend((x, False) for x in reversed(children))
    return canvas.result()


def _whole(value: str | None, default: int) -> int:
    """A whole number from 1 to 9999; anything else is the default."""
    return int(value) if value and value.isascii() and value.strip().isdigit() and len(value) < 5 and int(value) > 0 else default


def visible_text(page: str | None) -> str:
    """Visible text of a page; '' for null or empty."""
    return render(parse(page)) if page else ""


def extract(pages: DataFrame, *, html_col: str = "html", out_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all but the page by default) and the visible text of every row.

    Null and empty pages give ''.  Rows stay as many and as repeated as they were.  A kept column
    called like the output is replaced.
    """
    keep = [c for c in (keep if keep is not None else pages.columns) if c not in (html_col, out_col)]
    row = F.struct(F.lit(0), *[F.col(f"`{c}`").alias(c) for c in keep]).alias("row")  # one struct, so that no name can clash
    rows = pages.select(row, F.col(f"`{html_col}`").cast("string").alias("page"))
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                text = [visible_text(p.as_py()) for p in part.column("page")]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(text, pa.string())], ["row", "text"])

    return rows.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in keep], F.col("text").alias(out_col))


def op8_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of all pages."""
    out = extract(table(spark, sf_dir, "pages").select("page_id", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
