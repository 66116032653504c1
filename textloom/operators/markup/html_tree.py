"""A small element tree over the standard library's HTML parser."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that an opening tag closes, and the elements in which the search for them stops.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "thead": ({"tbody"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
BLOCKS = {"p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "hr", "section", "article", "figure"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.children: list[Node | str] = []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self) -> Iterator[Node]:
        """All elements below this one, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            n = todo.pop()
            yield n
            todo += [c for c in reversed(n.children) if isinstance(c, Node)]

    def find(self, *tags: str) -> Iterator[Node]:
        return (n for n in self.walk() if n.tag in tags)

    def holding(self, children: list[Node | str]) -> Node:
        """This element with the children in it."""
        self.children = children
        for c in children:
            if isinstance(c, Node):
                c.parent = self
        return self

    def strings(self) -> Iterator[str]:
        todo: list[Node | str] = [self]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                yield n
            else:
                todo += reversed(n.children)

    def text(self, joint: str = "", stripped: bool = False) -> str:
        parts = (s.strip() for s in self.strings()) if stripped else self.strings()
        return joint.join(s for s in parts if s or not stripped)

    def up(self, tag: str) -> Node | None:
        n = self.parent
        while n is not None and n.tag != tag:
            n = n.parent
        return n


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")

    def updatepos(self, i: int, j: int) -> int:
        """Line and column of a tag are never asked for; the parser would count line feeds at each."""
        return j

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            self._close(ends, stops)
        elif tag in BLOCKS:
            self._close({"p"}, {"td", "th", "li", "div", "blockquote", "table"})
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(n)
        if tag not in VOID:
            self.at = n

    def _close(self, ends: set[str], stops: set[str]) -> None:
        n, last = self.at, None
        while n is not None and n.tag not in stops and n.tag != "#root":
            if n.tag in ends:
                last = n
            n = n.parent
        if last is not None:
            self.at = last.parent

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def chooser(*selectors: str) -> Callable[[Node], bool]:
    """Whether an element is meant by one of the selectors: tag, .class, #id, and joined forms such as tag.class. They are read here, once, not at each element."""
    tags, joined = set(), []
    for s in selectors:
        m = re.fullmatch(r"([a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)", s)
        if not s or not m:
            raise ValueError(f"no selector: {s!r}")
        tag, parts = (m[1] or "").lower(), re.findall(r"([.#])([\w-]+)", m[2])
        if parts:
            joined.append((tag, {x for kind, x in parts if kind == "."}, {x for kind, x in parts if kind == "#"}))
        else:
            tags.add(tag)
    names = {x for _, classes, ids in joined for x in classes | ids}

    def meant(n: Node) -> bool:
        if n.tag in tags:
            return True
        if not n.attrs:
            return False
        own, id_ = n.classes, n.attrs.get("id")
        if id_ not in names and names.isdisjoint(own):  # most elements
            return False
        return any(tag in ("", n.tag) and classes.issubset(own) and ids <= {id_} for tag, classes, ids in joined)

    return meant
