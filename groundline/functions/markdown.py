"""HTML as Markdown with its structure: one pass over the tags, with a stack of the open lists, items and quotes.

A stack that writes as it goes is what column expressions cannot say in linear time, so the pass is a small Python
function over Arrow batches. `functions/html.py: to_markdown` is the flat form in the JVM.
"""

import html as entities
import re

import pyarrow as pa

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DEPTH = 32  # open lists, items and quotes that indent; what lies deeper is written as if it lay there
MAX_NUMBER = 999_999_999  # the largest item number that Markdown reads

INLINE = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`", "kbd": "`", "samp": "`", "tt": "`", "a": "a"}
BLOCKS = frozenset(
    "address article aside body caption dd details div dl dt fieldset figcaption figure footer form header hr html main nav p section summary".split()
)
HEADINGS = {f"h{n}": n for n in range(1, 7)}
RAW = {name: re.compile(rf"(?i)</{name}(?=[\s/>])[^>]*+>") for name in ("script", "style", "title")}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)>""")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])([^\s=>"'/]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+))""")
_SPACE = re.compile(r"[ \t\r\n\f\xa0]+")
_BREAKS = re.compile(r" ?(?:\n ?)+")
_TICKS = re.compile(r"`+")
_NUMBER = re.compile(r"\s*+([0-9]{1,9})\s*+\Z")
_UNSAFE = re.compile(r"[\s()<>]")


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _number(text: str | None, default: int) -> int:
    m = _NUMBER.match(text or "")
    return int(m[1]) if m else default


def _fence(content: str, least: int) -> str:
    """More backticks than stand together anywhere in the content."""
    return "`" * max(least, 1 + max((len(run) for run in _TICKS.findall(content)), default=0))


def _address(url: str) -> str:
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url.strip())


class _Open:
    """An open list, item or quote: what it puts before its first line and before the others."""

    def __init__(self, kind: str, first: str = "", rest: str = "", number: int | None = None):
        self.kind, self.first, self.rest, self.number, self.begun = kind, first, rest, number, not first


class _Writer:
    def __init__(self):
        self.out: list[str] = []
        self.stack: list[_Open] = []
        self.before: list[_Open] | None = None  # the stack at the block before
        self.over = {"list": 0, "quote": 0}  # opened beyond MAX_DEPTH
        self.text: list[str] = []
        self.inline: list[list] = []  # [mark, place in text, address, how often opened]
        self.heading = 0
        self.pre: list[str] | None = None
        self.info = ""
        self.rows: list[list[str]] | None = None  # of the open table
        self.in_cell = False
        self.inner_tables = 0

    # blocks

    def emit(self, lines: list[str]) -> None:
        """A block behind the marks of what is open; items of a list follow each other without an empty line."""
        if self.before is not None:
            common = [a for a, b in zip(self.before, self.stack) if a is b]
            tight = any(c.kind == "list" for c in common) and next((c.kind for c in self.stack if not c.begun), "") == "item"
            self.out.append("\n" if tight else "\n" + "".join(c.rest for c in common).rstrip() + "\n")
        rest = "".join(c.rest for c in self.stack)
        prefix = "".join(c.rest if c.begun else c.first for c in self.stack)
        for c in self.stack:
            c.begun = True
        for i, line in enumerate(lines):
            self.out.append((("\n" if i else "") + prefix + line).rstrip(" "))
            prefix = rest
        self.before = list(self.stack)

    def inline_text(self) -> str:
        """What was written since the last block; emphasis that is open ends here."""
        while self.inline:
            self.wrap(self.inline.pop())
        text = _BREAKS.sub("\n", re.sub(" +", " ", "".join(self.text))).strip(" \n")
        self.text.clear()
        return text

    def flush(self) -> None:
        text = self.inline_text()
        if text and self.heading:
            self.emit(["#" * self.heading + " " + text.replace("\n", " ")])
            self.heading = 0
        elif text:
            self.emit(text.split("\n"))

    def push(self, opened: _Open) -> None:
        self.flush()
        if len(self.stack) >= MAX_DEPTH:
            self.over[opened.kind] += 1
        else:
            self.stack.append(opened)

    def pop(self, kind: str) -> None:
        self.flush()
        if self.over.get(kind):
            self.over[kind] -= 1
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].kind == kind:
                del self.stack[at:]
                self.over = dict.fromkeys(self.over, 0)
                return
            if kind == "item" and self.stack[at].kind == "list":
                return

    def item(self, value: str | None) -> None:
        self.flush()
        self.pop("item")
        lists = [c for c in self.stack if c.kind == "list"]
        if not lists:
            lists = [_Open("list")]
            self.stack.append(lists[0])
        held = lists[-1]
        marker = "- "
        if held.number is not None:
            held.number = _number(value, held.number)
            marker = f"{held.number}. "
            held.number = min(held.number + 1, MAX_NUMBER)
        self.stack.append(_Open("item", marker, " " * len(marker)))

    # tables

    def end_cell(self) -> None:
        if self.in_cell:
            self.rows[-1].append(self.inline_text().replace("\n", " ").replace("|", "\\|"))
            self.in_cell = False
        else:
            self.flush()  # text between cells, such as a caption, is a block before the table

    def end_table(self) -> None:
        self.end_cell()
        rows = [row for row in self.rows if row]
        self.rows = None
        if rows:
            width = max(map(len, rows))
            rows[0] += [""] * (width - len(rows[0]))
            lines = ["| " + " | ".join(row) + " |" for row in rows]
            self.emit([lines[0], "|" + " --- |" * width, *lines[1:]])

    def table_tag(self, name: str, closing: bool) -> None:
        """A tag inside a table; tables, lists and blocks inside a cell become text of the cell."""
        if name == "table":
            self.inner_tables += -1 if closing and self.inner_tables else 0 if closing else 1
        elif not self.inner_tables and name in ("td", "th", "tr", "thead", "tbody", "tfoot"):
            self.end_cell()
            if name in ("td", "th"):
                if not closing:
                    self.rows = self.rows or [[]]
                    self.in_cell = True
            elif not closing:
                self.rows.append([])
        self.text.append(" ")

    # inside a line

    def wrap(self, frame: list) -> None:
        mark, place, address, _ = frame
        content = "".join(self.text[place:])
        del self.text[place:]
        inner = content.strip(" \n")
        if not inner or mark == "a" and address is None:
            self.text.append(content)
            return
        if mark == "a":
            wrapped = f"[{_BREAKS.sub(' ', inner)}]({address})"
        elif mark == "`":
            fence, edge = _fence(inner, 1), " " if inner[0] == "`" or inner[-1] == "`" else ""
            wrapped = fence + edge + inner + edge + fence
        else:
            wrapped = mark + inner + mark
        before = content[: len(content) - len(content.lstrip(" \n"))]
        after = content[len(content.rstrip(" \n")) :]
        self.text.append(before + wrapped + after)

    def begin_inline(self, mark: str, address: str | None = None) -> None:
        held = next((f for f in self.inline if f[0] == mark), None)
        if held is not None and mark != "a":
            held[3] += 1
            return
        if held is not None:
            self.end_inline(mark)  # a link ends the link before
        self.inline.append([mark, len(self.text), address, 1])

    def end_inline(self, mark: str) -> None:
        at = next((i for i, f in enumerate(self.inline) if f[0] == mark), None)
        if at is None:
            return
        self.inline[at][3] -= 1
        if self.inline[at][3] > 0:
            return
        above = self.inline[at + 1 :]
        while len(self.inline) > at:
            self.wrap(self.inline.pop())
        self.inline += [[f[0], len(self.text), f[2], f[3]] for f in above]

    # the pass

    def data(self, text: str) -> None:
        text = entities.unescape(text)
        if self.pre is not None:
            self.pre.append(text)
        else:
            self.text.append(_SPACE.sub(" ", text))

    def end_pre(self) -> None:
        content = "".join(self.pre).replace("\r\n", "\n").replace("\r", "\n")
        content = content.removeprefix("\n").rstrip("\n")
        self.pre = None
        if content:
            fence = _fence(content, 3)
            self.emit([fence + self.info, *content.split("\n"), fence])

    def pre_tag(self, name: str, closing: bool, attributes: str) -> None:
        if closing and name == "pre":
            self.end_pre()
        elif name == "br":
            self.pre.append("\n")
        elif name == "code" and not closing and not self.info:
            classes = _attributes(attributes).get("class", "").split()
            self.info = next((c[9:].replace("`", "") for c in classes if c.startswith("language-")), "")

    def tag(self, name: str, closing: bool, attributes: str) -> None:
        if self.pre is not None:
            self.pre_tag(name, closing, attributes)
        elif name in INLINE:
            if closing:
                self.end_inline(INLINE[name])
            else:
                url = _attributes(attributes).get("href") if name == "a" else None
                self.begin_inline(INLINE[name], None if url is None else _address(url))
        elif name == "br":
            self.text.append("\n")
        elif name == "img":
            found = _attributes(attributes)
            if not closing and found.get("src"):
                self.text.append(f"![{_SPACE.sub(' ', found.get('alt', ''))}]({_address(found['src'])})")
        elif self.rows is not None:
            if name == "table" and closing and not self.inner_tables:
                self.end_table()
            elif name in BLOCKS or name in HEADINGS or name in ("table", "td", "th", "tr", "thead", "tbody", "tfoot", "ul", "ol", "li", "blockquote", "pre"):
                self.table_tag(name, closing)
        else:
            self.block_tag(name, closing, attributes)

    def block_tag(self, name: str, closing: bool, attributes: str) -> None:
        if name in HEADINGS:
            self.flush()
            self.heading = 0 if closing else HEADINGS[name]
        elif name in ("ul", "ol"):
            start = _number(_attributes(attributes).get("start"), 1) if name == "ol" and not closing else None
            self.pop("list") if closing else self.push(_Open("list", number=start))
        elif name == "li":
            self.pop("item") if closing else self.item(_attributes(attributes).get("value"))
        elif name == "blockquote":
            self.pop("quote") if closing else self.push(_Open("quote", "> ", "> "))
        elif name == "table":
            self.flush()
            if not closing:
                self.rows, self.in_cell, self.inner_tables = [], False, 0
        elif name == "pre":
            self.flush()
            if not closing:
                self.pre, self.info = [], ""
        elif name in BLOCKS:
            self.flush()
            if name == "hr":
                self.emit(["---"])

    def run(self, page: str) -> str:
        pos = 0
        while (at := page.find("<", pos)) >= 0:
            self.data(page[pos:at])
            tag = _TAG.match(page, at)
            after = page[at + 1 : at + 2]
            if page.startswith("<!--", at):
                pos = page.find("-->", at + 4) + 3
                if pos == 2:
                    pos = len(page)
            elif tag:
                name, pos = tag[2].lower(), tag.end()
                if name in RAW and not tag[1]:
                    end = RAW[name].search(page, pos)
                    pos = end.end() if end else len(page)
                else:
                    self.tag(name, bool(tag[1]), tag[3])
            elif after and after in "!?/" and (end := page.find(">", at)) >= 0:
                pos = end + 1
            elif after.isalpha() or after and after in "!?/":
                self.data(page[at:])  # nothing closes it
                pos = len(page)
            else:
                self.data("<")
                pos = at + 1
        self.data(page[pos:])
        if self.pre is not None:
            self.end_pre()
        if self.rows is not None:
            self.end_table()
        self.flush()
        return "".join(self.out)


def markdown(page: str | None) -> str | None:
    """One HTML fragment or page as Markdown; see `nested_markdown`."""
    return None if page is None else _Writer().run(page)


def nested_markdown(html: Column) -> Column:
    """HTML as Markdown: headings, paragraphs, nested and numbered lists, quotes, tables, code, links, images, emphasis.

    - An item's further lines and lists are indented by the width of its marker; `start` and `value` of numbers count.
      An item without text is not written. Beyond 32 open lists, items and quotes nothing is indented further.
    - A table's first row is its header, as wide as the widest row. Lists, blocks and tables inside a cell become its text.
    - `pre` is a fenced block with the language that a `language-` class names; text is kept there as it stands.
    - Emphasis, code and links end with their block at the latest. Characters that Markdown reads are not escaped, but
      for `|` in cells.
    - Script, style and title are left out, to the end of the page if never closed, as is a comment. A tag that is never
      closed is text, and so is all after it. NULL stays NULL, an empty page is an empty text.

    Time grows with the page, whatever is opened and not closed in it; a page must fit in a task.
    """

    @F.arrow_udf("string")
    def written(pages: pa.Array) -> pa.Array:
        return pa.array((markdown(p.as_py()) for p in pages), pa.string())

    return written(html)
