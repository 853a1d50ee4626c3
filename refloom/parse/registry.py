"""Parsers by name: what a file is decoded with, split into and parsed by."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from . import base as B
from . import dialects as D
from . import text as T
from .xml_core import elements

Lookup = Callable[[str], str | None]


@dataclass(frozen=True)
class Parser:
    """blocks: (path, text, lookup) -> (bibcode, raw references); parse: raw references of one block -> a record each, or the error."""

    name: str
    encoding: str
    blocks: Callable[[str, str, Lookup], Iterator[tuple[str, list[str]]]]
    parse: Callable[[list[str]], list[dict | Exception]]


PARSERS: dict[str, Parser] = {}
#: Names under which seeds know two parsers.
ALIASES = {"AnAtexE2": "ADStex", "ADStexE2": "ADStex", "Blackwell": "BLACKWELL", "MNRAS": "BLACKWELL", "AIPE2": "AIP", "APSE2": "APS", "APSE3": "APS", "ELSEVIERE2": "ELSEVIER", "IOPE2": "IOP", "IOPE3": "IOP", "NATUREE2": "NATURE"}


def register_parser(parser: Parser) -> Parser:
    PARSERS[parser.name] = parser
    return parser


def parser_for(name: str) -> Parser | None:
    return PARSERS.get(ALIASES.get(name, name))


def _each(parse: Callable[[str], dict]) -> Callable[[list[str]], list[dict | Exception]]:
    """An error in one reference is its own."""

    def run(raws: list[str]) -> list[dict | Exception]:
        out: list[dict | Exception] = []
        for raw in raws:
            try:
                out.append(parse(raw))
            except Exception as error:  # noqa: BLE001
                out.append(error)
        return out

    return run


def _text_parser(f: T.TextFormat) -> Parser:
    return Parser(f.name, f.encoding, f.blocks, _each(f.fields or (lambda raw: B.record(refstr=f.clean(raw)))))


def _xml_parser(d: D.Dialect) -> Parser:
    def blocks(path: str, text: str, lookup: Lookup) -> Iterator[tuple[str, list[str]]]:
        if d.name == "LivingReviews":
            parts = [(lookup(os.path.basename(path).replace(".living.xml", "").strip()) or "", text)]
        else:
            parts = list(B.header_blocks(text)) or [(B.filename_bibcode(path) or "", text)]
        for bibcode, body in parts:
            body = B.rewrite(body, d.block_rules)
            if d.name == "VERSITA":  # a reference a line, some without their element
                body = " ".join(line if line.startswith("<ref") and line.endswith("</ref>") else f"{line if line.startswith('<ref') else f'<ref id="none">{line}'}</ref>" for line in map(str.strip, body.splitlines()) if line and not line.endswith("</title>"))
            raws = [r for r in elements(body, d.tag) if not (d.name == "CrossRef" and r.strip().endswith("/>"))]
            raws = [s for r in raws for s in (d.split(r) if d.split else [r])]
            if raws:
                yield bibcode, raws

    def parse(raws: list[str]) -> list[dict | Exception]:
        if d.carry:  # what a reference takes may itself be taken over
            filled: list[str] = []
            for raw in raws:
                before = filled[-1] if filled else ""
                filled.append(D.carry_over(before, raw, d.carry, r"<ibid\s*/?>" if "journal" in d.carry else r"-{3,}"))
            raws = filled
        return _each(lambda raw: D.parse_reference(raw, d))(raws)

    return Parser(d.name, d.encoding, blocks, parse)


for _f in T.ALL:
    register_parser(_text_parser(_f))
for _d in D.ALL:
    register_parser(_xml_parser(_d))
