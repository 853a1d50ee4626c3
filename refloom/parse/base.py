"""What all parsers share: fields out of strings, blocks out of files, references out of blocks. Plain functions of strings."""

from __future__ import annotations

import html
import os
import unicodedata
from collections.abc import Iterable, Iterator

import regex as re

from ..functions import expressions as X
from ..schemas import REFERENCE_FIELDS

BIBCODE = re.compile(r"^[12]\d{3}[A-Za-z&.]{5}[\w.&]{9}[A-Z.:]$|^\d{4}.{15}$")
IN_NAME = re.compile(r"^([12\d]\d{3}.{15})")
WHITE_SQUARE = "#9633"  # the code whose line in an entity table marks what is unknown


# Characters ----------------------------------------------------------------


def to_ascii(text: str) -> str:
    """Plain ASCII: accents come off, dashes and quotes become simple, what has no such form is left out."""
    simple = {"–": "-", "—": "-", "−": "-", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...", "×": "x", "ß": "ss", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "đ": "d", "Đ": "D", "ı": "i", "\xa0": " "}
    spelled = "".join(simple.get(c, c) for c in text)
    return unicodedata.normalize("NFKD", spelled).encode("ascii", "ignore").decode()


def entities_to_ascii(text: str, table: dict[str, str] | None = None) -> str:
    """Named, decimal and hexadecimal entities as ASCII; `__amp__` stands for an ampersand.

    table: ASCII by name, as sources.files.entity_table() reads it; names that it lacks become what it has for a white
    square. Without a table names go by rule, and unknown ones stay.
    """

    def plain(m: re.Match) -> str:
        if table and m[1][0] != "#":
            return table.get(m[1], table.get(WHITE_SQUARE, ""))
        found = html.unescape(m[0])
        return to_ascii(found) if found != m[0] else m[0]

    text = text.replace("__amp__", "&").replace("&amp;", "&")
    return re.sub(r"&(#\d+|#[xX][0-9A-Fa-f]+|\w+);", plain, text)


def to_entities(text: str) -> str:
    """Other than ASCII as named entities, numbered where there is no name."""
    from html.entities import codepoint2name

    return "".join(c if ord(c) < 128 else f"&{codepoint2name.get(ord(c), f'#{ord(c)}')};" for c in text)


def clean_all(text: str) -> str:
    return to_ascii(entities_to_ascii(text)).strip()


def url_decode(text: str) -> str:
    """Each %XX as the character of that code."""
    return re.sub(r"%([A-Fa-f0-9]{2})", lambda m: chr(int(m[1], 16)), text)


def strip_tags(text: str, change: str = " ") -> str:
    return re.sub(r"<.*?>", change, text).strip()


# Fields of a citation ------------------------------------------------------

_YEAR, _YEAR_IN, _ROMAN = re.compile(X.YEAR), re.compile(X.YEAR_IN_PARENTHESES), re.compile(X.ROMAN)
_DOI, _OLD, _NEW = [re.compile(p) for p in X.DOI_PATTERNS], re.compile(X.ARXIV_OLD), re.compile(X.ARXIV_NEW)


def match_year(text: str | None) -> str | None:
    years = set(_YEAR.findall(text or ""))
    if len(years) == 1:
        return years.pop()
    hit = _YEAR_IN.search(text or "") if years else None
    return hit and hit[1]


def match_doi(text: str | None) -> str | None:
    return next((m[1] for p in _DOI if (m := p.search(text or ""))), None)


def match_arxiv_id(text: str | None) -> str | None:
    if m := _OLD.search(text or ""):
        return f"{m[1]}/{m[2]}"
    m = _NEW.search(text or "")
    return m and f"{m[1]}.{m[2]}"


def match_int(text: str | list | None) -> str | None:
    m = re.search(r"\d+", (text[0] if isinstance(text, list) and text else text or "") or "")
    return m and m[0]


def parse_volume(text: str | None) -> str:
    if m := re.search(r"\d+", text or ""):
        return m[0]
    m = _ROMAN.search(text or "")
    return m[1] if m else ""


def parse_pages(page: str | None, ignore: str = "", letters: str = "") -> tuple[str, str | None]:
    if not page:
        return "", None
    head, rest, qualifier = page[0], page, None
    if head in "LA" or head in letters:
        rest, qualifier = page[1:], head
    elif head in ignore:
        rest = page[1:]
    elif page[-1] in "sS":
        rest, qualifier = page[:-1], "S"
    elif head in "sS":
        rest, qualifier = page[1:], "S"
    m = re.search(r"\d+", re.sub(r"\s", "", rest))
    return (m[0] if m else ""), qualifier


def page_with_letter(page: str | None, ignore: str = "", letters: str = "") -> str:
    number, qualifier = parse_pages(page, ignore, letters)
    return (qualifier or "") + number


def int_to_roman(n: int) -> str:
    if not 1 <= n <= 4000:
        raise ValueError(f"{n} has no roman numeral")
    out = ""
    for sign, value in X.ROMAN_VALUES.items():
        out += sign * (n // value)
        n %= value
    return out


def roman_to_int(text: str) -> int:
    if not text or not _ROMAN.match(text.upper()):
        raise ValueError(f"{text} is no roman numeral")
    values = [X.ROMAN_VALUES[c] for c in text.upper()]
    return sum(-v if any(w > v for w in values[k + 1 : k + 2]) else v for k, v in enumerate(values))


def reference_string(r: dict) -> str | None:
    """The canonical citation of a record, see functions.expressions.reference_string()."""
    a, y, j, t, v, p, d, e = (r.get(k) or None for k in ("authors", "year", "journal", "title", "volume", "page", "doi", "arxiv"))
    tail = "".join(f", {x}" for x in (v, p) if x) + "."
    form = None
    if a and y:
        if j and (v or p):
            form = f"{a}, {y}. {j}, {t}{tail}" if t else f"{a}, {y}. {j}{tail}"
        elif j and (d or e):
            form = f"{a}, {y}. {j}."
        elif t:
            form = f"{a}, {y}. {t}{tail}"
        elif d or e:
            form = f"{a}, {y}."
    if form:
        return form + (f" doi:{d}" if d else "") + ("" if not e else f" {e}" if "arxiv" in e.lower() else f" arXiv:{e}")
    return ", ".join(x for x in (a, y, j, t, v, p, d, e) if x) if d or e else None


def plain_text(text: str) -> str:
    bare = re.sub(r"http\S+", "", text).strip()
    sound = re.search(r"\w{3,}", bare) and re.search(r"\b[12][098]\d\d\w?\b|\d+(st|nd|rd|th)+", bare)
    return re.sub(r"\s+", " ", bare) + ("" if sound else X.INCOMPLETE)


def record(**fields) -> dict:
    """Only the fields that say something, by their names in the schema."""
    return {k: v for k in REFERENCE_FIELDS if (v := fields.get(k))}


def extract_tag(text: str, tag: str, keep: bool = False, fold: bool = False, attributes: bool = False, remove: bool = True, greedy: bool = False) -> tuple[str, str | None]:
    """(rest, content) of the first element with a tag."""
    m = re.search(f"<{tag}{'[^>]*' if attributes else ''}>({'.*' if greedy else '.*?'})</{tag}>", text or "", flags=re.I if fold else 0)
    if not m:
        return text or "", None
    return (text[: m.start()] + text[m.end() :] if remove else text), (m[0] if keep else m[1])


def format_authors(text: str) -> str:
    """`F. Last and G. Other` as `Last F., Other G.`; et al. goes last."""
    et_al = re.search(r"\bet\s+al\.?", text)
    if et_al:
        text = text[: et_al.start()] + text[et_al.end() :]
    out = []
    for name in re.split(r"\s*(?:,|\band\b|&)\s*", text):
        parts, first = name.split(), []
        while len(parts) > 1 and re.match(r"\b\w\.", parts[0]):
            first.append(parts.pop(0))
        out.append(" ".join(parts + first))
    return ", ".join([n for n in out if n] + ([et_al[0]] if et_al else []))


# LaTeX ---------------------------------------------------------------------

_LATEX = [(re.compile(p), re.sub(r"\$(\d)", r"\\\1", to)) for p, to in X.LATEX_RULES]


def latex_to_text(text: str, macros: dict[str, str] | None = None) -> str:
    if macros and "\\" in text:
        text = re.sub("|".join(re.escape(m) + r"\b" for m in sorted(macros, key=len, reverse=True)), lambda m: macros[m[0]], text)
    for pattern, to in _LATEX:
        text = pattern.sub(to, text)
    return text.strip()


# References and blocks -----------------------------------------------------


def as_list(value) -> list | None:
    """A string or bytes alone in a list, other iterables as a list, None as it is."""
    return None if value is None else [value] if isinstance(value, (str, bytes)) else list(value)


def rewrite(text: str, rules: Iterable[tuple[str, str]]) -> str:
    for pattern, to in rules:
        text = re.sub(pattern, to, text)
    return text


def is_bibcode(text: str | None) -> bool:
    return bool(text) and len(text) == 19 and bool(BIBCODE.match(text))


def is_reference(text: str) -> bool:
    """Has a year, DOI or arXiv id, or an author, a volume and a page."""
    if _YEAR.search(text) or match_doi(text) or match_arxiv_id(text):
        return True
    return bool(re.search(r"[A-Z]\w+,\s+[A-Z]\..*\b\d+,\s*[A-Z]?\d+", text))


def inherit(current: str, previous: str, placeholder: str = r"^\s*-{2,}") -> str:
    """A leading placeholder as what the previous reference has before its year in parentheses, unless that is at its end."""
    m = re.match(placeholder, current)
    if not m or not previous:
        return current
    head = re.match(rf"(.*?)\s*\({_YEAR.pattern}\)(?=.*\w)", previous) or re.match(r"(.*?)\s+(?=\b[12][09]\d\d[a-z]?\b.*\w{3})", previous)
    if not head or not re.search(r"\w", previous[head.end() :].strip(" ().,")):
        return current
    return f"{head[1].strip()} {current[m.end() :].strip()}"


def chain(references: Iterable[str], **options) -> list[str]:
    """inherit() along a list, each from its already filled predecessor."""
    out: list[str] = []
    for r in references:
        out.append(inherit(r, out[-1] if out else "", **options))
    return out


def split_enumeration(line: str) -> list[str]:
    """`(1) a; (2) b` as its items; other lines as they are."""
    items = re.split(r"(?:^|;\s*)\(\d+\)\s*", line.strip())
    return [i.strip() for i in items if i.strip()] if len(items) > 1 else [line.strip()]


def filename_bibcode(path: str) -> str | None:
    m = IN_NAME.match(os.path.basename(path))
    return m and m[1]


def item_number(numbers: list | None, at: int) -> dict:
    """The number of a reference in a buffer, as a field; none if there is no such."""
    return {"item_num": numbers[at]} if numbers and -len(numbers) <= at < len(numbers) else {}


def detect_format(text: str) -> str | None:
    for mark, name in ((r"<ADSBIBCODE>", "xml"), (r"\\adsbibcode\{", "tex"), (r"^%R ", "tag")):
        if re.search(mark, text, flags=re.M | re.I):
            return name
    return None


def tagged_blocks(text: str) -> Iterator[tuple[str, list[str]]]:
    """(bibcode, lines) of %R headers: lines from %Z on, without %Z."""
    for part in re.split(r"^%R\s+", text, flags=re.M)[1:]:
        head, _, rest = part.partition("\n")
        body = re.split(r"^%Z\s?", rest, maxsplit=1, flags=re.M)
        if len(body) == 2:
            lines = [line.strip() for line in body[1].splitlines() if line.strip() and not line.startswith("%")]
            yield head.strip(), lines


def header_blocks(text: str) -> Iterator[tuple[str, str]]:
    """(bibcode, text) of <ADSBIBCODE> headers."""
    parts = re.split(r"<ADSBIBCODE>\s*(.*?)\s*</ADSBIBCODE>", text, flags=re.I | re.S)
    yield from zip(parts[1::2], parts[2::2])
