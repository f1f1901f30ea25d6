"""Visible text of HTML pages, laid out.

A tree is built with the tags that HTML lets authors leave out: open paragraphs,
list items, table cells, rows and options end where the next one begins, the
head ends at the first thing it may not hold, cells get a row, and stray end
tags are passed over. Elements are invisible by their
kind, by ``hidden``, by ``display:none`` or ``visibility:hidden`` in their style
or in simple rules of the page's style sheets (comments and the blocks of at-rules
apart; of media blocks those for all media or the screen count, without looking
at their conditions on size), or inside closed ``details`` and
``dialog``. The visible tree is laid out as lines: blocks begin new lines,
paragraphs, headings, lists and tables stand apart by an empty line, list items
have bullets or numbers and are indented by their depth, table cells are aligned
in columns, and preformatted text keeps its white space.

Defined cases: null and empty pages give empty text; a page of any depth and
length is laid out whole; cells wider than PAD characters are not padded but
never cut; repeated rows are laid out each. Other columns are never looked at.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAD = 40
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_CSS = re.compile(r"([^{};]*)([{};])")
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)")
_LONG_REFERENCE = re.compile(r"&#(?:([0-9]{8,})|([xX][0-9a-fA-F]{8,}));?")
_SPACES = re.compile(r"[ \t\n\r\f]+")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title datalist iframe noembed noframes object audio video canvas area param rp".split())
UNDRAWN = frozenset("defs desc metadata symbol clippath annotation annotation-xml".split())  # of svg and math
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre hr figure fieldset menu form".split())
BLOCKS = APART | frozenset("address article aside body caption center details dialog dd div dt figcaption footer header hgroup html legend li main nav option optgroup section summary tbody td tfoot th thead tr".split())
ENDS_PARAGRAPH = APART | frozenset("address article aside center details dialog dd div dt figcaption footer header hgroup main nav section summary li".split())
#: An opening tag ends the open elements named first, as far up as one of those named last.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")), "tr": (("tr",), ("table",)),
    "thead": (("thead", "tbody", "tfoot"), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _unescaped(text: str) -> str:
    """Character references replaced; a number of any length is read, and one beyond all characters is U+FFFD."""

    def short(found: re.Match) -> str:
        mark, digits = ("", found[1]) if found[1] else (found[2][0], found[2][1:])
        digits = digits.lstrip("0") or "0"
        return f"&#{mark}{digits};" if len(digits) < 8 else "\ufffd"

    return html.unescape(_LONG_REFERENCE.sub(short, text) if "&#" in text else text)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): _unescaped(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


class Open:
    """The elements still open, and how many there are of each tag, so that no search is made in vain."""

    def __init__(self, root: Node):
        self.nodes, self.count = [root], Counter()

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.count[node.tag] += 1

    def close(self, tags: tuple[str, ...], limits: tuple[str, ...]) -> None:
        """Ends the nearest open element with one of the tags, and all inside it, unless a limit stands before it."""
        if not any(self.count[t] for t in tags):
            return
        for at in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[at].tag in tags:
                self.count.subtract(n.tag for n in self.nodes[at:])
                del self.nodes[at:]
                return
            if self.nodes[at].tag in limits:
                return


def _add_text(stack: Open, text: str) -> None:
    """Text of a page; one that is not blank ends the head it stands in."""
    if stack.nodes[-1].tag == "head" and text.strip(" \t\n\r\f"):
        stack.close(("head",), ())
    stack.nodes[-1].children.append(_unescaped(text))


def parse(page: str) -> Node:
    root = Node("#root", {})
    stack, at = Open(root), 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if found is None:
            _add_text(stack, page[at:])
            break
        if found.start() > at:
            _add_text(stack, page[at:found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                if stack.nodes[-1].tag == "head":
                    stack.close(("head",), ())
                stack.nodes[-1].children.append(Node("br", {}))
            elif tag in ("body", "html") and stack.count["head"] and not stack.count["body"]:
                stack.close(("head",), ("template",))
            elif tag not in VOID:
                limits = () if tag in ("table", "body", "html") else ("td", "th", "caption") if tag not in ("td", "th", "tr", "caption", "tbody", "thead", "tfoot") else ("table",)
                stack.close((tag,), limits)
            continue
        if tag == "body" or (tag not in IN_HEAD and stack.nodes[-1].tag == "head"):
            stack.close(("head",), ("template",))
        if tag in ENDS_PARAGRAPH:
            stack.close(("p",), ("td", "th", "caption", "button", "table"))
        if tag in ENDS:
            stack.close(*ENDS[tag])
        if tag in ("td", "th") and stack.nodes[-1].tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr", {})
            stack.nodes[-1].children.append(row)
            stack.push(row)
        node = Node(tag, _attributes(found[3]))
        if tag in UNDRAWN and (stack.count["svg"] or stack.count["math"]):
            node.attributes["hidden"] = ""
        stack.nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            inner = page[at:end.start() if end else len(page)]
            node.children.append(_unescaped(inner) if tag in ("textarea", "title") else inner)
            at = end.end() if end else len(page)
        elif tag not in VOID and not found[3].rstrip().endswith("/"):
            stack.push(node)
        elif tag not in VOID and tag in BLOCKS:
            stack.push(node)  # a slash ends no element that may have content
    return root


def _walk(root: Node) -> Iterator[Node]:
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]


def _for_screen(condition: str) -> bool:
    """Whether a media list names all media or the screen; conditions on size are not looked at."""
    for one in condition.lower().split(","):
        kind = re.match(r"\s*(not\s+|only\s+)?([a-z-]*)", one)
        if (kind[2] in ("", "all", "screen")) != ((kind[1] or "").strip() == "not"):
            return True
    return False


def css_rules(sheet: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations of the rules that hold on a screen."""
    sheet = _CSS_COMMENT.sub(" ", sheet)
    # One entry for each open brace: the selectors of a rule, or None for a block of rules; whether it holds; its declarations.
    opened: list[tuple[str | None, bool, list[str]]] = [(None, True, [])]
    for part in _CSS.finditer(sheet):
        before, mark = part[1].strip(), part[2]
        outer, holds, body = opened[-1]
        if mark == "{":
            at = before.lower()
            holds = holds and outer is None  # what is nested in a rule has no simple selector
            if at.startswith("@"):
                opened.append((None, holds and (_for_screen(at[6:]) if at.startswith("@media") else at.startswith(("@layer", "@supports"))), []))
            else:
                opened.append((before, holds, []))
            continue
        body.append(before)
        if mark == "}" and len(opened) > 1:
            opened.pop()
            if outer is not None and holds:
                yield outer, ";".join(body)


def hidden_selectors(root: Node) -> set[str]:
    """Simple selectors (tag, .class, #id or tag.class) that the style sheets hide."""
    found = set()
    for node in _walk(root):
        if node.tag == "style" and _for_screen(node.attributes.get("media", "")):
            for selectors, rules in css_rules("".join(c for c in node.children if isinstance(c, str))):
                if _HIDES.search(rules.lower()):
                    found |= {s.strip() for s in selectors.split(",") if re.fullmatch(r"\s*[\w-]*(?:[.#][\w-]+)?\s*", s) and s.strip()}
    return found


def visible(node: Node, selectors: set[str]) -> bool:
    a = node.attributes
    if node.tag in UNSEEN or "hidden" in a or _HIDES.search(a.get("style", "").lower()) or (node.tag == "input" and a.get("type", "").lower() in ("hidden", "password")):
        return False
    if node.tag == "dialog" and "open" not in a:
        return False
    names = {node.tag, *(f"{t}.{c}" for c in a.get("class", "").split() for t in ("", node.tag))}
    if "id" in a:
        names |= {f"#{a['id']}", f"{node.tag}#{a['id']}"}
    return not names & selectors


class Lines:
    """Lines under way: white space collapses, blocks and items start lines of their own."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = self.gap = False
        self.indent: list[str] = []
        self.marker = ""

    def _begin(self) -> None:
        if not self.parts:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = self.space = False
            prefix = "".join(self.indent)
            if self.marker:
                prefix = prefix[:max(0, len(prefix) - len(self.marker))] + self.marker
                self.marker = ""
            self.parts.append(prefix)

    def text(self, value: str) -> None:
        words = _SPACES.sub(" ", value)
        if words.strip(" "):
            if (words[0] == " " or self.space) and self.parts:
                words = " " + words.lstrip(" ")
            else:
                words = words.lstrip(" ")
            self._begin()
            self.space = words.endswith(" ")
            self.parts.append(words.rstrip(" "))
        elif words:
            self.space = True

    def kept(self, value: str) -> None:
        for n, line in enumerate(value.replace("\r\n", "\n").split("\n")):
            if n:
                self.end(always=True)
            if line:
                self._begin()
                self.parts.append(line)

    def end(self, always: bool = False) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip())
            self.parts = []
        elif always and self.lines:
            self.lines.append("")
        self.space = False

    def apart(self) -> None:
        self.end()
        self.gap = True

    def result(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _width(text: str) -> int:
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _number(value: str | None, default: int, most: int = 1000) -> int:
    digits = value.lstrip("0") if value and value.isascii() and value.isdigit() else ""
    return min(int(digits[:12]), most) if digits else default


def table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of (lines, columns, rows) cells as aligned lines. Cells that span rows leave their place empty below."""
    grid: list[dict[int, list[str]]] = []
    taken: dict[int, int] = {}
    for row in rows:
        placed: dict[int, list[str]] = {}
        column, below = 0, {c: n - 1 for c, n in taken.items() if n > 1}
        for lines, wide, high in row:
            while taken.get(column, 0) > 0:
                column += 1
            placed[column] = lines
            for c in range(column, column + wide):
                if high > 1:
                    below[c] = high - 1
            column += wide
        grid.append(placed)
        taken = below
    widths: dict[int, int] = {}
    for placed in grid:
        for c, lines in placed.items():
            widths[c] = max(widths.get(c, 0), *(min(PAD, _width(x)) for x in lines), 0) if lines else widths.get(c, 0)
    columns = sorted(widths)
    out = []
    for placed in grid:
        for n in range(max((len(x) for x in placed.values()), default=0)):
            cells = [placed[c][n] if c in placed and n < len(placed[c]) else "" for c in columns]
            line = "  ".join(x + " " * (widths[c] - _width(x)) for c, x in zip(columns, cells))
            out.append(line.rstrip())
    return out


def layout(root: Node) -> str:
    """The visible text of a tree. Entering and leaving elements are steps of a list, so depth is no limit."""
    selectors = hidden_selectors(root)
    page = Lines()
    now, holders = page, []
    tables: list[list] = []
    lists: list[list] = []
    pre = 0
    todo: list[tuple[object, bool]] = [(root, True)]
    while todo:
        node, entering = todo.pop()
        if isinstance(node, str):
            now.kept(node) if pre else now.text(node)
            continue
        tag = node.tag
        if entering:
            if not visible(node, selectors):
                continue
            if tag == "br":
                now.end(always=True)
                continue
            if tag == "input":
                now.text(f" {node.attributes.get('value', '')} ")
                continue
            if tag in APART and not (lists and tag in ("ul", "ol", "menu")):
                now.apart()
            elif tag in BLOCKS:
                now.end()
            if tag in ("ul", "ol", "menu"):
                lists.append([_number(node.attributes.get("start"), 1, 10 ** 9) if tag == "ol" else None])
                now.indent.append("  ")
            elif tag == "li":
                depth = lists[-1] if lists else [None]
                now.marker = "- " if depth[0] is None else f"{depth[0]}. "
                if depth[0] is not None:
                    depth[0] += 1
                now.indent.append("  " if not lists else "")
            elif tag in ("dd", "blockquote"):
                now.indent.append("  ")
            elif tag in ("pre", "textarea"):
                pre += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables and tables[-1]:
                holders.append((now, lists, pre))
                now, lists, pre = Lines(), [], 0
            todo.append((node, False))
            children = node.children
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            todo += [(c, True) for c in reversed(children)]
            continue
        if tag in ("ul", "ol", "menu"):
            lists.pop()
            now.end()
            now.indent.pop()
        elif tag in ("li", "dd", "blockquote"):
            now.end()
            now.marker = ""
            now.indent.pop()
        elif tag in ("pre", "textarea"):
            pre -= 1
        elif tag in ("td", "th") and tables and tables[-1]:
            cell = (now.result(), _number(node.attributes.get("colspan"), 1), _number(node.attributes.get("rowspan"), 1))
            now, lists, pre = holders.pop()
            tables[-1][-1].append(cell)
        elif tag == "table":
            now.apart()
            for line in table_lines(tables.pop()):
                now.kept(line)
                now.end(always=True)
        if tag in APART and not (lists and tag in ("ul", "ol", "menu")):
            now.apart()
        elif tag in BLOCKS:
            now.end()
    return "\n".join(page.result())


def visible_text(page: str | None) -> str:
    return layout(parse(page)) if page else ""


def extract(pages: DataFrame, id: str = "page_id", markup: str = "html") -> DataFrame:
    """id and text of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(p.as_py()) for p in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=[id, "text"])

    rows = pages.select(F.col(id), F.col(markup).alias("_markup"))
    return rows.mapInArrow(run, f"`{id}` {rows.schema[id].dataType.simpleString()}, text string")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
