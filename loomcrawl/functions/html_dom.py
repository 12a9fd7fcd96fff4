"""A small lenient HTML tree on the standard library's tokenizer, for functions that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

# Fixed values of HTML: elements without content, elements that an opening tag ends, and what they do not reach across.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
WALLS = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "dt": {"dl"}, "dd": {"dl"}}
BLOCKS = frozenset("address article aside blockquote body div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """The nodes below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def raw_text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in ("script", "style") or n is self:
                out.append(" " if n.tag == "br" else "")
                stack.extend(reversed(n.children))
        return "".join(out)

    def text(self) -> str:
        """Text below with white space collapsed."""
        return " ".join(self.raw_text().split())

    def words(self, attribute: str) -> list[str]:
        return self.attrs.get(attribute, "").split()

    def has_class(self, *names: str) -> bool:
        return not set(names).isdisjoint(self.words("class"))

    def by_class(self, *names: str) -> list[Node]:
        return [n for n in self.walk() if n.has_class(*names)]

    def ancestors(self) -> Iterator[Node]:
        n = self.parent
        while n is not None:
            yield n
            n = n.parent


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def _close(self, tags: set[str], walls: set[str]) -> None:
        n, top = self.at, None
        while n.parent is not None and n.tag not in walls:
            if n.tag in tags:
                top = n
            n = n.parent
        if top is not None:
            self.at = top.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS:
            self._close(ENDS[tag], WALLS.get(tag, {"table", "td", "th", "li", "button"}))
        elif tag in BLOCKS and self.at.tag == "p":
            self.at = self.at.parent
        n = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(n)
        if tag not in VOID:
            self.at = n

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n.parent is not None and n.tag != tag:
            if tag != "table" and n.tag == "table":
                return
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page; a page that cannot be read further keeps what was read."""
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except (AssertionError, ValueError, RecursionError):
        pass
    return b.root


def source(n: Node | str) -> str:
    """A node written as HTML again."""
    from html import escape

    if isinstance(n, str):
        return escape(n, quote=False)
    inner = "".join(map(source, n.children))
    if n.tag == "#root":
        return inner
    attrs = "".join(f' {k}="{escape(v)}"' for k, v in n.attrs.items())
    return f"<{n.tag}{attrs}>" if n.tag in VOID else f"<{n.tag}{attrs}>{inner}</{n.tag}>"
