"""HTML extraction by layout-aware rendering.

A tree builder turns markup into elements: void elements, raw text (script, style), implied end tags (p, li, dt, dd, option,
rows, cells, table parts), implied rows, and end tags that close what is still open inside.  A renderer walks the tree,
leaves out what is not shown (head, scripts, ``hidden``, ``display:none`` and ``visibility:hidden`` by attribute or by the
page's own style sheets, closed details, SVG outside its text elements) and emits all other text: white space collapsed, blank lines around
paragraphs, headings, lists and tables, list markers with indents (of at most ``DEEPEST`` columns), table cells in aligned
columns, ``pre`` as it is.  Cells keep their lines, so lists and tables inside them stay what they are; a line of more than
``WIDEST`` characters with another cell to its right is broken at blanks, so that columns stay aligned and padding bounded;
``colspan`` and ``rowspan`` are honoured.

Rules for other media than the screen are skipped.  Rules cascade by importance, specificity and order.  A rule counts as
hiding only where it is sure to apply (a compound of tag, classes and id; no media features); one that shows also counts
where it may apply, so that text is kept in doubt.

Edge cases: null html gives null, empty html an empty text; broken markup is text or is closed at the end; nesting of any
depth takes no recursion; very long texts and attributes are read whole; of style rules that tie the later one counts; repeated
rows and extra columns are kept, whatever their names: only a column called ``html_text`` is replaced; an empty table gives an
empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import with_columns

WIDEST, DEEPEST = 60, 400
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SHEET = re.compile(r"([^{};]*)([{};])")
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)[^;!]*(!\s*important)?", re.I)
_COMPOUND = re.compile(r"(?:\*|[a-zA-Z][\w-]*)?(?:[.#][\w-]+)*")
#: states that a page isn't in when it is opened, and boxes that aren't elements
_NEVER = re.compile(r":(?:hover|focus|active|target|visited|before|after|first-line|first-letter|placeholder|selection|backdrop|marker)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style title template noscript iframe object audio video canvas datalist noembed noframes meta link".split())
UNDRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr form fieldset".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer nav main address li dt dd details summary figcaption caption center dir menu legend tr td th tbody thead tfoot option optgroup".split()
)
_ENDS_P = SPACED | frozenset("div section article aside header footer nav main address details figcaption center dir menu li dt dd summary".split())
#: start tag: (what it ends, where the search for that stops)
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"tbody", "thead", "tfoot", "table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
_ENDS["thead"] = _ENDS["tfoot"] = _ENDS["tbody"]
_HEAD_ONLY = frozenset("html head title meta link style script base noscript template".split())


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if raw and not raw.isspace():
        for name, value in _ATTRIBUTE.findall(raw):
            out.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in "\"'" else value) if value else "")
    return out


def _foreign(stack: list[Element]) -> bool:
    """Whether svg or math is open, where any element may close itself."""
    for e in reversed(stack):
        if e.tag in ("svg", "math"):
            return True
        if e.tag in ("foreignobject", "annotation-xml"):
            return False
    return False


def build(source: str) -> tuple[Element, list[str]]:
    """(root, style sheets)."""
    root = Element("html", {})
    stack, styles, at = [root], [], 0

    def close_down(wanted: set[str], stop: set[str]) -> None:
        """Closes the outermost run of open elements that wanted names, seen from inside as far as stop."""
        depth = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in stop:
                break
            if stack[k].tag in wanted:
                depth = k
        if depth is not None:
            del stack[depth:]

    while True:
        m = _TOKEN.search(source, at)
        text = source[at : m.start() if m else len(source)]
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                stack.pop()
            stack[-1].children.append(html.unescape(text) if "&" in text else text)
        if not m:
            return root, styles
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break  # an end tag inside a cell closes nothing outside
            else:
                if tag in ("p", "br"):
                    stack[-1].children.append(Element(tag, {}))
            continue
        if not m[2]:
            continue
        tag = m[2].lower()
        raw = m[3] or ""
        if tag == "html":
            root.attributes |= _attributes(raw)
            continue
        if stack[-1].tag == "head" and tag not in _HEAD_ONLY:
            stack.pop()
        if tag in _ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in ("td", "th", "table", "button", "caption"):
                    break
        if tag in _ENDS:
            close_down(*_ENDS[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Element("tr", {})
            stack[-1].children.append(row)
            stack.append(row)
        element = Element(tag, _attributes(raw))
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
            inner = source[at : end.start() if end else len(source)]
            if tag == "style":
                styles.append(f"@media {element.attributes['media']}{{{inner}}}" if element.attributes.get("media", "").strip() else inner)
            elif tag != "script":
                element.children.append(html.unescape(inner))
            at = end.end() if end else len(source)
        elif tag not in VOID and not (raw.endswith("/") and (tag in ("svg", "math") or _foreign(stack))):
            stack.append(element)


def _applies(at_rule: str) -> bool | None:
    """Whether a block's rules apply on a screen; None if that can't be told."""
    m = re.match(r"@([\w-]+)\s*(.*)", at_rule, re.S)
    name, rest = m[1].lower() if m else "", m[2].lower() if m else ""
    if name == "layer":
        return True
    if name in ("supports", "container", "scope"):
        return None
    if name != "media":
        return False
    found: list[bool | None] = []
    for query in rest.split(","):
        q = re.fullmatch(r"\s*(only\s+|not\s+)?([\w-]+)?\s*(.*)", query, re.S)
        met = q[2] in ("screen", "all") if q[2] else True
        if (q[1] or "").strip() == "not":
            found.append(None if q[3] or not q[2] else not met)
        else:
            found.append(None if met and q[3] else met)
    return True if True in found else None if None in found else False


def _declared(body: str) -> dict[str, tuple[bool, bool]]:
    """display and visibility: (important, shown)."""
    out: dict[str, tuple[bool, bool]] = {}
    for name, value, important in _DECLARED.findall(body):
        name, value = name.lower(), value.lower()
        new = (bool(important), value not in ("none", "hidden", "collapse"))
        if name not in out or new[0] >= out[name][0]:
            out[name] = new
    return out


def rules(styles: list[str]) -> dict[str, list[tuple]]:
    """By one name that it asks for ("*" if none): (all names, property, sure, rank, shown) of each rule for display and visibility."""
    out: dict[str, list[tuple]] = {}
    order = 0
    for sheet in styles:
        sheet = re.sub(r"/\*.*?(?:\*/|$)|<!--|-->", "", sheet, flags=re.S)
        open_blocks: list[bool | None] = []  # whether each open block applies
        selectors, body = None, ""
        for text, sign in [*_SHEET.findall(sheet), ("", "}")]:
            if selectors is not None:  # in a rule
                body += text + ";"
                if sign != "}":
                    continue
                sure = False if False in open_blocks else None if None in open_blocks else True
                declared = _declared(body) if sure is not False else {}
                for selector in selectors.split(",") if declared else ():
                    selector, order = selector.strip(), order + 1
                    if not selector or _NEVER.search(selector):
                        continue
                    whole = bool(_COMPOUND.fullmatch(selector))
                    weight = (selector.count("#"), len(re.findall(r"[.\[]|(?<!:):(?!:)", selector)), len(re.findall(r"(?:^|[\s>+~])[a-zA-Z]", selector)))
                    last = selector if whole else re.split(r"[\s>+~]+", re.sub(r"\([^()]*\)|\[[^\]]*\]", "", selector).strip())[-1]
                    names = re.findall(r"[.#][\w-]+", re.sub(r":+[\w-]+", "", last))
                    if tag := re.match(r"[a-zA-Z][\w-]*", last):
                        names.append(tag[0].lower())
                    for kind, (important, shown) in declared.items():
                        certain = whole and sure is True
                        if certain or shown:
                            out.setdefault(names[0] if names else "*", []).append((frozenset(names), kind, certain, (important, 0, *weight, order), shown))
                selectors = None
            elif sign == "{":
                head = text.strip()
                if head.startswith("@"):
                    open_blocks.append(_applies(head))
                else:
                    selectors, body = head, ""
            elif sign == "}" and open_blocks:
                open_blocks.pop()
    return out


def _state(e: Element, found: dict[str, list[tuple]]) -> dict[str, bool]:
    """Whether display and visibility show the element, where anything says so."""
    a, ranked = e.attributes, []
    if "hidden" in a and a["hidden"] != "until-found" or e.tag == "dialog" and "open" not in a:
        ranked.append(("display", True, (False, -1), False))
    if a.get("style"):
        ranked += [(kind, True, (important, 1), shown) for kind, (important, shown) in _declared(re.sub(r"/\*.*?\*/", "", a["style"], flags=re.S)).items()]
    if found:
        names = {e.tag, *("." + c for c in a.get("class", "").split()), *(["#" + a["id"]] if a.get("id") else [])}
        ranked += [r[1:] for n in (*names, "*") for r in found.get(n, ()) if r[0] <= names]
    out = {}
    for kind in {r[0] for r in ranked}:
        top = max((r for r in ranked if r[0] == kind and r[1]), key=lambda r: r[2], default=None)
        out[kind] = top is None or top[3] or any(r[0] == kind and r[3] and r[2] > top[2] for r in ranked)
    return out


class _Sheet:
    """Text under way: lines, and how many line breaks are due before the next text."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.due = 0  # line breaks before the next text; 2 leave a blank line
        self.space = False
        self.indent = ""
        self.marker = ""
        self.fresh = True  # nothing on the current line yet
        self.rigid = False  # holds lines that must not be broken

    def gap(self, breaks: int) -> None:
        if self.out:
            self.due = max(self.due, breaks)
        self.space = False
        self.fresh = True

    def line(self) -> None:
        """A forced line break."""
        if self.out:
            self.due = self.due + 1 if self.due else 1
        self.space, self.fresh = False, True

    def _begin(self) -> None:
        if self.fresh:
            self.out.append("\n" * self.due + (self.indent[: len(self.indent) - len(self.marker)] + self.marker if self.marker else self.indent))
            self.due, self.fresh, self.marker = 0, False, ""

    def text(self, s: str) -> None:
        words = s.split()
        if not words:
            self.space = self.space or bool(s) and not self.fresh
            return
        lead = (s[0].isspace() or self.space) and not self.fresh
        self._begin()
        self.out.append((" " if lead else "") + " ".join(words))
        self.space = s[-1].isspace()

    def verbatim(self, s: str) -> None:
        self.rigid = True
        for k, part in enumerate(s.replace("\r\n", "\n").split("\n")):
            if k:
                self.line()
            if part.strip():
                self._begin()
                self.out.append(part.rstrip() if part != s else part)

    def result(self) -> str:
        return "".join(self.out)


def _number(value: str, most: int, beyond: int) -> int:
    """A span: 1 unless it is a number above 0; more than ``most`` counts as ``beyond``."""
    m = re.match(r"\s*\+?0*([1-9][0-9]*)", value)
    return 1 if not m else int(m[1]) if len(m[1]) < 9 and int(m[1]) <= most else beyond


def _broken(lines: list[str]) -> list[str]:
    """Lines of more than WIDEST characters broken at blanks."""
    out = []
    for line in lines:
        if len(line) <= WIDEST:
            out.append(line)
            continue
        now: list[str] = []
        size = 0
        for word in line.split(" "):
            if now and size + len(word) > WIDEST:
                out.append(" ".join(now))
                now, size = [], 0
            now.append(word)
            size += len(word) + 1
        out.append(" ".join(now))
    return out


def _table(rows: list[list[tuple[list[str], bool, int, int]]]) -> list[str]:
    """Lines of a table of (lines, rigid, colspan, rowspan) cells, columns aligned."""
    grid: list[list[tuple[int, int, list[str]]]] = []  # (column, columns, lines) of the cells with text
    taken: dict[int, int] = {}  # column: rows that a cell from above still takes
    for cells in rows:
        line: list[tuple[int, int, list[str]]] = []
        column, now = 0, taken
        taken = {c: n - 1 for c, n in now.items() if n > 1}
        last = max((k for k, cell in enumerate(cells) if any(cell[0])), default=-1)
        for k, (lines, rigid, across, down) in enumerate(cells):
            while now.get(column):
                column += 1
            if any(lines):
                line.append((column, across, lines if rigid or k == last else _broken(lines)))
            if down > 1:
                taken.update({c: down - 1 for c in range(column, column + across)})
            column += across
        grid.append(line)
    # only cells with another to their right hold that one off
    held = [(c, across, max(map(len, lines))) for line in grid for c, across, lines in line[:-1]]
    columns = sorted({c for line in grid for c, _, _ in line} | {c + across for c, across, _ in held})
    begin = dict.fromkeys(columns, 0)
    ends: dict[int, list[tuple[int, int]]] = {}
    for c, across, size in held:
        ends.setdefault(c + across, []).append((c, size))
    for before, c in zip(columns, columns[1:]):
        begin[c] = max([begin[before] + 2 * (before >= 0), *(begin[first] + size + 2 for first, size in ends.get(c, ()))])
    out = []
    for line in grid:
        for k in range(max((len(lines) for _, _, lines in line), default=0)):
            text = ""
            for c, _, lines in line:
                if k < len(lines) and lines[k]:
                    text = text.ljust(begin[c]) if len(text) <= begin[c] else text + "  "
                    text += lines[k]
            out.append(text.rstrip())
    return out


_ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


def _ordinal(n: int, kind: str) -> str:
    """A list item's number as its list's type has it; numbers that a type doesn't have stay decimal."""
    out = ""
    if kind in ("a", "A") and n > 0:
        while n:
            n, k = divmod(n - 1, 26)
            out = chr(97 + k) + out
    elif kind in ("i", "I") and 0 < n < 4000:
        for value, sign in _ROMAN:
            out += sign * (n // value)
            n %= value
    else:
        return str(n)
    return out.upper() if kind in ("A", "I") else out


def _whole(value: str) -> int | None:
    m = re.match(r"\s*([+-]?[0-9]{1,9})", value)
    return int(m[1]) if m else None


def render(source: str) -> str:
    """The text that the page shows."""
    root, styles = build(source)
    found = rules(styles)
    sheet = _Sheet()
    #: one frame for each sheet, table or list that is open, put back when its element ends
    lists: list[list] = []
    tables: list[list] = []
    work: list[tuple] = [("open", root, True, False, None)]  # the last: in SVG, whether its text is drawn
    while work:
        kind, node, seen, pre, drawn = work.pop()
        if kind == "text":
            if seen and drawn is not False:
                sheet.verbatim(node) if pre else sheet.text(node)
            continue
        tag = node.tag
        if kind == "close":
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            if tag in ("ul", "ol", "menu", "dir", "blockquote", "dd") or tag == "li":
                sheet.indent = node.attributes.pop(" indent")
                if tag == "li":
                    sheet.marker = ""
            if tag in ("td", "th") and tables and " sheet" in node.attributes:
                inner, sheet = sheet, node.attributes.pop(" sheet")
                a = node.attributes
                lines = [x.rstrip() for x in inner.result().split("\n")]
                tables[-1][-1].append((lines, inner.rigid, _number(a.get("colspan", ""), 1000, 1), _number(a.get("rowspan", ""), 65534, 65534)))
                continue
            if tag == "table":
                for line in _table(tables.pop()):
                    if line:
                        sheet.gap(1)
                        sheet.verbatim(line)
            if tag in ("mtr", "mtd", "mfrac") or tag == "text" and drawn:
                sheet.text(" ")
            if tag == "q" and seen:
                sheet.text('"')
            if tag in BLOCK:
                sheet.gap(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
            continue
        a = node.attributes
        if tag in UNSEEN:
            continue
        state = _state(node, found) if a or found or tag == "dialog" else {}
        if tag == "input" or not state.get("display", True):
            continue
        seen = state.get("visibility", seen)
        if drawn is not None and tag in UNDRAWN or tag == "annotation":
            continue
        if tag == "svg":
            drawn = False
        elif drawn is not None and tag in ("text", "foreignobject"):
            drawn = None if tag == "foreignobject" else True
            sheet.text(" ")
        elif tag in ("mtr", "mtd", "mfrac"):
            sheet.text(" ")
        if tag == "br":
            sheet.line()
            continue
        if tag == "hr":
            sheet.gap(2)
            continue
        if tag == "img":
            continue
        if tag in BLOCK and not (tag in ("td", "th") and tables):
            sheet.gap(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
        if tag in ("ul", "ol", "menu", "dir", "blockquote", "dd", "li"):
            a[" indent"] = sheet.indent
            if tag == "li":
                counter = lists[-1] if lists else [None]
                if counter[0] is None:
                    mark = "- "
                else:
                    if (own := _whole(a.get("value", ""))) is not None:
                        counter[0] = own
                    mark = f"{_ordinal(counter[0], a.get('type', counter[2]))}. "
                    counter[0] += counter[1]
                sheet.indent = sheet.indent[:DEEPEST] + " " * len(mark)
                sheet.marker = mark
                sheet.fresh = True
            elif tag in ("blockquote", "dd"):
                sheet.indent = sheet.indent[:DEEPEST] + "  "
            if tag in ("ul", "ol", "menu", "dir"):
                down = "reversed" in a
                start = _whole(a.get("start", ""))
                if start is None:
                    start = sum(isinstance(c, Element) and c.tag == "li" for c in node.children) if down else 1
                lists.append([start, -1 if down else 1, a.get("type", "")] if tag == "ol" else [None])
        if tag == "table":
            tables.append([])
        if tag == "tr" and tables:
            tables[-1].append([])
        if tag in ("td", "th") and tables:
            if not tables[-1]:
                tables[-1].append([])
            a[" sheet"], sheet = sheet, _Sheet()
        if tag == "q" and seen:
            sheet.text('"')
        children = node.children
        if tag == "details" and "open" not in a:
            children = [c for c in children if isinstance(c, Element) and c.tag == "summary"][:1]
        inner_pre = pre or tag in ("pre", "listing", "xmp", "textarea")
        if tag == "pre" and children and isinstance(children[0], str) and children[0].startswith("\n"):
            children = [children[0][1:], *children[1:]]
        work.append(("close", node, seen, pre, drawn))
        for c in reversed(children):
            if not isinstance(c, str):
                work.append(("open", c, seen, inner_pre, drawn))
            elif not (tag in ("table", "tr", "tbody", "thead", "tfoot", "ul", "ol") and c.isspace()):
                work.append(("text", c, seen, inner_pre, drawn))
    return sheet.result()


def extract(pages: DataFrame) -> DataFrame:
    """Replaces html by html_text in pages(html, ...)."""
    at = [c.lower() for c in pages.drop("html_text").columns].index("html")
    start = lambda: lambda batch: [pa.array([None if s is None else render(s) for s in batch.column(at).to_pylist()], pa.string())]
    return with_columns(pages, "html_text string", start, ("html",))
