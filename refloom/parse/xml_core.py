"""Tolerant XML: a reference that is not well-formed is mended tag by tag, and at last read as plain text."""

from __future__ import annotations

from xml.etree import ElementTree as ET

import regex as re

from .base import entities_to_ascii

TRIES = 4


class Node:
    """An element tree with lookups by tag that do not care about depth. Texts have entities as ASCII and single spaces."""

    def __init__(self, root: ET.Element) -> None:
        self.root = root

    @staticmethod
    def _text(e: ET.Element) -> str:
        return re.sub(r"\s+", " ", entities_to_ascii(" ".join(t for t in e.itertext()))).strip()

    def all(self, tag: str, **attributes: str) -> list[ET.Element]:
        wanted = {k.replace("_", "-"): v for k, v in attributes.items()}
        return [e for e in self.root.iter(tag) if all(e.get(k) == v for k, v in wanted.items())]

    def has(self, tag: str) -> bool:
        return next(self.root.iter(tag), None) is not None

    def text(self, *tags: str, **attributes: str) -> str:
        """The first text that is not empty, tags in order of preference."""
        return next((t for tag in tags for e in self.all(tag, **attributes) if (t := self._text(e))), "")

    def texts(self, tag: str, **attributes: str) -> list[str]:
        return [t for e in self.all(tag, **attributes) if (t := self._text(e))]

    def attribute(self, tag: str, name: str) -> str:
        """Of the first element with the tag, else of its children, one after another."""
        first = next(self.root.iter(tag), None)
        if first is None:
            return ""
        return (first.get(name) or "".join(c.get(name) or "" for c in first)).strip()

    def attribute_texts(self, tag: str, name: str) -> dict[str, str]:
        """Attribute value -> text of the elements with the tag."""
        out: dict[str, str] = {}
        for e in self.root.iter(tag):
            if e.get(name) and self._text(e):
                out.setdefault(e.get(name), self._text(e))
        return out

    def attribute_where(self, tag: str, match: dict[str, str], name: str) -> str:
        return next((e.get(name) or "" for e in self.root.iter(tag) if any(e.get(k) == v for k, v in match.items())), "")

    def within(self, tag: str, **attributes: str) -> list[Node]:
        return [Node(e) for e in self.all(tag, **attributes)]

    def whole(self) -> str:
        return self._text(self.root)

    def markup(self) -> str:
        return ET.tostring(self.root, encoding="unicode")

    def own_text(self, tag: str) -> str:
        """Texts directly inside the elements with the tag, not those of elements within."""
        return "".join((e.text or "") + "".join(c.tail or "" for c in e) for e in self.root.iter(tag)).strip()


def parse(text: str) -> Node:
    """The tree of one reference. Namespace prefixes are dropped."""
    text = re.sub(r"\s+", " ", text.replace("\n", " ")).replace("> <", "><").strip()
    text = re.sub(r"<(/?)[A-Za-z]+:(?=[A-Za-z])", r"<\1", text)
    text = re.sub(r"\s[A-Za-z]+:([A-Za-z-]+=)", r" \1", text).replace("&", "__amp__")
    for _ in range(TRIES):
        try:
            return Node(ET.fromstring(text))
        except ET.ParseError as error:
            at = error.position[1]
            start = text.rfind("<", 0, at + 1)
            end = text.find(">", at)
            bogus = text[start : end + 1]
            if start < 0 or end < 0 or bogus.startswith("</") or bogus.count("<") != 1 or start == 0:
                break
            text = text.replace(bogus, "")
    tag = re.match(r"<?([A-Za-z][\w.-]*)", text)
    root = ET.Element(tag[1] if tag else "text")
    root.text = re.sub(r"[<>]", " ", re.sub(r"<[^<]+?>", " ", text))
    return Node(root)


def elements(text: str, tag: str) -> list[str]:
    """The outermost elements of one tag (alternatives with |), as text, in order."""
    out, depth, start, name = [], 0, 0, ""
    for m in re.finditer(rf"<(/?)({tag})(?=[\s>/])[^>]*?(/?)>", text):
        closing, found, empty = m[1], m[2], m[3]
        if depth == 0 and not closing and not empty:
            depth, start, name = 1, m.start(), found
        elif depth and found == name:
            depth += -1 if closing else (0 if empty else 1)
            if depth == 0:
                out.append(text[start : m.end()])
    return out
