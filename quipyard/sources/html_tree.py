"""Element tree of one page, built with the standard HTML parser.

End tags without an open counterpart are ignored, unclosed tags stay open and
hold what follows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

# Elements that never have content.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Elements whose text is not page text.
HIDDEN_TAGS = frozenset(("script", "style", "template"))


class Text(str):
    """Page text."""


class Hidden(str):
    """Comments, and the content of scripts and the like."""


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag = tag
        self.attrs = attrs
        self.children: list[Element | Text | Hidden] = []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def descendants(self) -> Iterator[Element | Text | Hidden]:
        """All nodes below this one in document order."""
        pending = self.children[::-1]
        while pending:
            node = pending.pop()
            yield node
            if isinstance(node, Element):
                pending.extend(reversed(node.children))

    def find_all(self, match: Callable[[Element], bool]) -> Iterator[Element]:
        return (n for n in self.descendants() if isinstance(n, Element) and match(n))

    def find(self, match: Callable[[Element], bool]) -> Element | None:
        return next(self.find_all(match), None)

    def remove_all(self, match: Callable[[Element], bool]) -> None:
        """Cut matching elements out, with all they hold."""
        pending = [self]
        while pending:
            node = pending.pop()
            node.children = [c for c in node.children if not (isinstance(c, Element) and match(c))]
            pending.extend(c for c in node.children if isinstance(c, Element))

    def texts(self) -> Iterator[str]:
        return (n for n in self.descendants() if isinstance(n, Text))

    def stripped_text(self) -> str:
        """Text nodes trimmed and put together without a separator."""
        return "".join(t.strip() for t in self.texts())

    def only_string(self) -> str | None:
        """The string of an element that holds nothing else, however deep."""
        node = self
        while len(node.children) == 1:
            node = node.children[0]
            if isinstance(node, str):
                return str(node)
        return None


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]
        self.open_tags: dict[str, int] = {}
        self.buffer: list[str] = []

    def _flush(self) -> None:
        data = "".join(self.buffer)
        self.buffer.clear()
        if not data:
            return
        if not data.strip(" \t\n\r\f"):
            data = "\n" if "\n" in data else " "
        hidden = any(self.open_tags.get(t) for t in HIDDEN_TAGS)
        self.open[-1].children.append((Hidden if hidden else Text)(data))

    def _hide(self, data: str) -> None:
        self._flush()
        self.open[-1].children.append(Hidden(data))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._flush()
        element = Element(tag, {name: value or "" for name, value in attrs})
        self.open[-1].children.append(element)
        if tag not in VOID_TAGS:
            self.open.append(element)
            self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        while self.open_tags.get(tag):
            closed = self.open.pop()
            self.open_tags[closed.tag] -= 1
            if closed.tag == tag:
                return

    def handle_data(self, data: str) -> None:
        self.buffer.append(data)

    def handle_comment(self, data: str) -> None:
        self._hide(data)

    def handle_decl(self, decl: str) -> None:
        self._hide(decl)

    def handle_pi(self, data: str) -> None:
        self._hide(data)

    def unknown_decl(self, data: str) -> None:
        self._hide(data)

    def close(self) -> None:
        super().close()
        self._flush()


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root
