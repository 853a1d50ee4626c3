"""Text, pairs, OCR, TeX and HTML files: how each splits into blocks of references, and what is cleaned off."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import regex as re

from . import base as B
from .macros import MACROS

Blocks = Iterator[tuple[str, list[str]]]
Rules = list[tuple[str, str]]


@dataclass(frozen=True)
class TextFormat:
    """blocks: (path, text, lookup) -> (bibcode, references as they stand); clean: one of them -> its text."""

    name: str
    blocks: Callable[..., Blocks]
    clean: Callable[[str], str] = lambda t: t
    encoding: str = "UTF-8"
    fields: Callable[[str], dict] | None = None


# Text ----------------------------------------------------------------------


def _tagged(path: str, text: str, lookup: Callable) -> Blocks:
    for bibcode, lines in B.tagged_blocks(text):
        yield bibcode, B.chain(item for line in lines for item in B.split_enumeration(line))


#: What starts a numbered reference.
ENUMERATED = r"^\s*[\[(]?\d{1,3}[\]).]?\s+(?=[A-Z\"'(])"


def _numbered(path: str, text: str, lookup: Callable) -> Blocks:
    """The bibcode from the file name; if any line is numbered, a number starts a reference and other lines go on with it."""
    lines = [line.strip() for line in text.splitlines() if line.strip() and not line.startswith("%")]
    if any(re.match(ENUMERATED, line) for line in lines):
        joined: list[str] = []
        for line in lines:
            if re.match(ENUMERATED, line) or not joined:
                joined.append(re.sub(ENUMERATED, "", line))
            else:
                joined[-1] += f" {line}"
        lines = joined
    if bibcode := B.filename_bibcode(path):
        yield bibcode, B.chain(lines)


def _flat(path: str, text: str, lookup: Callable) -> Blocks:
    if bibcode := B.filename_bibcode(path):
        yield bibcode, B.chain(line.strip() for line in text.splitlines() if line.strip() and B.is_reference(line))


def _ibid(path: str, text: str, lookup: Callable) -> Blocks:
    """Numbered lines of tagged blocks; `ibid.` starts another reference, with what stands before volume and year of the one before."""
    before_volume = r"^(.*?)(?=[\s.,]+\d+[\s(]+[12]\d{3}[a-z]*)"
    for bibcode, lines in B.tagged_blocks(text):
        out: list[str] = []
        for line in lines:
            parts = re.split(r"(?:^|[;,.\s]+)ibid\.", re.sub(r"^\d+ ", "", line))
            for k, part in enumerate(parts):
                whole = part.strip()
                if k and (m := re.match(before_volume, out[-1] if out else "")):
                    whole = f"{m[1].strip()} {part.strip(' ,;')}"
                if B.is_reference(whole):
                    out.append(B.inherit(whole, out[-1] if out else ""))
        yield bibcode, out


def _three_stems(path: str, text: str, lookup: Callable) -> Blocks:
    """By how many block marks there are, and by the journal's directory."""
    journal = (path.split("/") + ["", "", ""])[-3] if path.count("/") < 2 else path.split("/")[-3]
    if len(re.findall(r"%R|%Z", text)) > 1:
        yield from (_numbered if journal == "ARA+A" else _tagged)(path, text, lookup)
    else:
        yield from _flat(path, text, lookup)


def _pairs(path: str, text: str, lookup: Callable) -> Blocks:
    held: dict[str, list[str]] = {}
    for line in text.splitlines():
        if not line.strip() or line.startswith("#"):
            continue
        if ";" in line:
            source, cited, *said = [p.strip() for p in line.split(";", 2)]
            held.setdefault(source, []).append(";".join([cited, *said]))
        elif "\t" in line:
            cited, source = (p.strip() for p in line.split("\t")[:2])
            held.setdefault(source, []).append(cited)
    yield from ((b, r) for b, r in held.items() if b and any(r))


#: What e-print listings leave in references, before and after entities are replaced.
EPRINT_FIRST: Rules = [(r"[{}]", ""), (r"\\(it|bf)", ""), (r"<A HREF=.*?>", ""), (r"</A>", ""), (r"&amp;", "&"), (r"&nbsp;", " "), (r"(&#65533;)+", "")]
EPRINT_THEN: Rules = [
    (r" (ApJ|ApJS|MNRAS|Nature),", r", \1,"), (r"BIBLIOGRAPHY, +p\. +\d+ +", ""), (r"^\d+\. ", ""), (r"\|+\.", "---"), (r"^[A-Z ]+ \d+", ""), (r"^\s*\[\d*\]\s*", ""),
    (r"astroph", "astro-ph"), (r"astro- ph", "astro-ph"), (r"astro-ph/\s+", "astro-ph/"), (r'"et al\."', "et al."),
]


def clean_eprint(text: str) -> str:
    return B.rewrite(B.entities_to_ascii(B.rewrite(text, EPRINT_FIRST)), EPRINT_THEN)


def clean_latex(text: str) -> str:
    return B.latex_to_text(B.entities_to_ascii(text), MACROS)


# OCR -----------------------------------------------------------------------

#: Punctuation and misread digits around a number that starts a reference.
NOISE = re.escape("!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\\")
NOISY_NUMBER = rf"^\s*[{NOISE}]*[\dOoIiSsta]{{1,3}}[a-z]?[{NOISE}\s]+(?=.*[A-Z][.\s]+)"


def _assemble(lines: list[str], start: str) -> list[str]:
    out: list[str] = []
    for line in lines:
        if re.search(start, line) or not out:
            out.append(re.sub(start, "", line).strip())
        else:
            out[-1] += f" {line.strip()}"
    return out


def _ocr_noisy(path: str, text: str, lookup: Callable) -> Blocks:
    if bibcode := B.filename_bibcode(path):
        yield bibcode, B.chain(r for r in _assemble([x for x in text.splitlines() if x.strip()], NOISY_NUMBER) if B.is_reference(r))


def _ocr(path: str, text: str, lookup: Callable) -> Blocks:
    """A line starts a reference if it starts like an author and the one before it is complete; words cut by a hyphen are joined."""
    out: list[str] = []
    for line in (x.strip() for x in re.sub(r"(\w)-\n\s*(?=[a-z])", r"\1", text).splitlines()):
        if not line:
            continue
        starts = re.match(r"(?:-{2,}|[A-Z][\w'’-]+,?\s+(?:[A-Z]\.|[A-Z][\w'-]+))", line)
        if out and not (starts and B.is_reference(out[-1])):
            out[-1] += f" {line}"
        else:
            out.append(line)
    if bibcode := B.filename_bibcode(path):
        yield bibcode, B.chain(r for r in out if B.is_reference(r))


# TeX -----------------------------------------------------------------------


def _tex(path: str, text: str, lookup: Callable) -> Blocks:
    """Blocks of %R or \\adsbibcode{}; a \\bibitem starts a reference, without any each line is one."""
    marked = re.sub(r"\\adsbibcode\{(.*?)\}", r"%R \1\n%Z", text)
    for part in re.split(r"^%R\s+", marked, flags=re.M)[1:]:
        head, _, body = part.partition("\n")
        body = re.sub(r"^%Z\s?", "", body, count=1, flags=re.M)
        body = re.sub(r"(?<!\\)%.*", "", re.sub(r"\\(begin|end)\{.*?\}(\{.*?\})?", "", body))
        items = re.split(r"\\bibitem(?:\[.*?\])?(?:\{.*?\})?", body, flags=re.S)
        refs = [" ".join(i.split()) for i in (items[1:] if len(items) > 1 else body.splitlines()) if i.strip()]
        if head.strip() and refs:
            yield head.strip(), B.chain(refs)


# HTML ----------------------------------------------------------------------

#: Markup that is no part of a reference.
HTML_RULES: Rules = [
    (r"(?s)<!--.*?-->", ""), (r"(?is)<script.*?</script>", ""), (r"(?is)<font.*?</font>", ""), (r"(?i)<img\s[^>]*>", ""), (r"(?is)<a\s+href=.*?</a>", ""), (r"(?i)<a\s+(name|target)=[^>]*>", ""), (r"(?i)<highwire id=.*?>", ""), (r"(?i)<table [^>]*>", ""),
    (r"(?i)</?(tr|td|br|ul|font|a|li|p)>", ""), (r"&#15[01];", "-"), (r"NASA ADS", " "), (r"(?i)\s+\[Abstract\]", ""), (r"\s+", " "),
]
REVIEW_RULES: Rules = [(r"(?s)<!--.*?-->", ""), (r"(?i)</?(nobr|bio|tr|td|i|b|em|strong|dt|dd|tt|sub|sup)[^>]*>", ""), (r"(?is)<span.*?</span>", ""), (r"(?i)<(p|a|table|img|option)\b[^>]*>", ""), (r"(?i)</(p|a|img|option)>", ""), (r"&amp;", "&"), (r"&nbsp;", " "), (r"&#8211;", "-"), (r"<\d+:[A-Z]+>", ""), (r"(?i)\s+\[Abstract\]", ""), (r"\s+", " ")]
BULLETIN_RULES: Rules = [(r"<!-- [^>]* -->", ""), (r"<FONT [^>]*>", ""), (r"(?i)<a\s+href=[^>]*>", ""), (r"(?i)<img\s[^>]*>", ""), (r"(?i)</?(font|a|p|h1|br)>", ""), (r"&amp;", "&"), (r"\*", ""), (r"&nbsp;", " "), (r"\s+", " ")]
EDUCATION_RULES: Rules = [(r'(?i)<span class="ref\w+">', ""), (r'(?i)<a name="[^>]*">', ""), (r"(?is)<a\s+href=.*?</a>", ""), (r"(?i)</?(a|span|em)>", ""), (r"\s+", " ")]


def _items(pattern: str, text: str, rules: Rules) -> list[str]:
    found = re.finditer(pattern, text, flags=re.I | re.S)
    return [r for m in found if (r := B.rewrite(next((g for g in m.groups() if g), ""), rules).strip())]


def _html(pattern: str, rules: Rules = HTML_RULES, headed: bool = False, split: str = ""):
    """Items of a pattern, for the file's bibcode or those of its headers."""

    def blocks(path: str, text: str, lookup: Callable) -> Blocks:
        for bibcode, part in B.header_blocks(text) if headed else [(B.filename_bibcode(path), text)]:
            refs = [s.strip() for r in _items(pattern, part, rules) for s in (re.split(split, r) if split else [r]) if s.strip()]
            if bibcode and refs:
                yield bibcode, B.chain(refs)

    return blocks


def _review(path: str, text: str, lookup: Callable) -> Blocks:
    """The bibcode is looked up by the file's DOI; a reference's own DOI, which is in a script, is put after it."""
    flat = re.sub(r"[\t\r\n]", " ", text)
    doi = re.search(r"(?i)\(doi:(.*?)\)", flat)
    bibcode = doi and lookup(doi[1])
    refs: list[str] = []
    for m in re.finditer(r'(?is)(?:<nobr>|<tr><td[^>]*>|<td valign="top" class="fulltext[^>]*>)\s*(.*?)(<script.*?</script>|$)', flat):
        said = B.rewrite(m[1], REVIEW_RULES).strip()
        own = re.search(r"(?i)genRefLink.*?'(10[^']*)'", m[2])
        if said:
            refs.append(B.inherit(said, refs[-1] if refs else "") + (f" (doi:{B.url_decode(own[1])})" if own else ""))
    if bibcode and refs:
        yield bibcode, refs


def _education(path: str, text: str, lookup: Callable) -> Blocks:
    """The bibcode is made of the page's own citation: the issue is a letter, and issue 2 belongs to the year before. A page of five digits takes the letter's place too."""
    flat = re.sub(r"\s", " ", text)
    author = re.search(r'(?i)<p class="author">\s*by\s+<strong>(.*?)</strong>', flat)
    cited = re.search(r"(?i)Issue\s+(\d+),\s+Volume\s+(\d+):(\d+)-\d+,\s+([12]\d{3})", flat)
    if not author or not cited:
        return
    issue, volume, page, year = cited.groups()
    initial = author[1].split(",")[0].split()[-1][0]
    bibcode = f"{int(year) - (issue == '2')}AEdRv{volume.rjust(4, '.')}{('oabcdefghijkl'[int(issue)] + page.rjust(4, '.'))[-max(5, len(page)):]}{initial}"
    refs = _items(r'<p\s+class="reference">(.*?)</p>', text, EDUCATION_RULES)
    if refs:
        yield bibcode, B.chain(refs)


def _earth(path: str, text: str, lookup: Callable) -> Blocks:
    if os.path.basename(path).startswith("annurev"):
        yield from _review(path, text, lookup)
    else:
        yield from _html(r"<TD>(.*?)(?=</TD>|<TD>|$)")(path, text, lookup)


def _said(pair: str) -> dict:
    """A pairs reference is a bibcode, with a text or without."""
    cited, _, text = pair.partition(";")
    return B.record(refstr=pair, bibcode=cited if len(cited) == 19 else None) if text else B.record(refstr=cited, bibcode=cited if len(cited) == 19 else None)


ALL = [
    TextFormat("ADStxt", _tagged, clean_latex), TextFormat("ARAnATXT", _numbered, clean_latex, "ISO-8859-1"), TextFormat("PThPhTXT", _ibid, clean_latex, "ISO-8859-1"), TextFormat("FlatTXT", _flat, clean_latex, "ISO-8859-1"),
    TextFormat("ThreeBibsTxt", _three_stems, clean_latex, "ISO-8859-1"), TextFormat("PairsTXT", _pairs, encoding="ISO-8859-1", fields=_said), TextFormat("arXiv", _tagged, clean_eprint),
    TextFormat("ADSocr", _ocr, B.entities_to_ascii, "ISO-8859-1"), TextFormat("ObsOCR", _ocr_noisy, B.entities_to_ascii, "ISO-8859-1"), TextFormat("ADStex", _tex, clean_latex),
    TextFormat("ADSHTML", _html(r"<LI>\s*(.*?)(?=<LI>|</UL>|</OL>|$)"), B.entities_to_ascii), TextFormat("AnAhtml", _html(r"<LI>\s*(.*?)(?=<LI>|</UL>)"), B.entities_to_ascii), TextFormat("AnAShtml", _html(r"<LI>\s*(.*?)(?=<LI>)"), B.entities_to_ascii),
    TextFormat("AnnRevHTML", _review, B.entities_to_ascii), TextFormat("AnRFMhtml", _review, B.entities_to_ascii), TextFormat("ARAnAhtml", _review, B.entities_to_ascii), TextFormat("AEdRvHTML", _education, B.entities_to_ascii), TextFormat("AREPSHTML", _earth, B.entities_to_ascii),
    TextFormat("JLVEnHTML", _html(r'<TR><TD\s+valign="top">(.*?)</TD>'), B.entities_to_ascii), TextFormat("PASJhtml", _html(r"<A\s+[^>]*>(.*?)(?=</A>|</FONT>)|\s\*\s+(.*?)(?=\s\*\s|<HR>)|<FONT[^>]*>\s*([A-Z].*?)(?=</FONT>)|<P>(?:\*&nbsp;)?([^<]+)(?=<P>)", BULLETIN_RULES, True, r"\(RC\d\)"), B.entities_to_ascii, "ISO-8859-1"),
    TextFormat("PASPhtml", _html(r"<CITATION ID=[^>]*>(.*?)</CITATION>", headed=True), B.entities_to_ascii),
]
FORMATS = {f.name: f for f in ALL}
