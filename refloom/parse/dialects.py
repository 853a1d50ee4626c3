"""The XML dialects of publishers, as descriptions: which tags hold which field, and what is peculiar to each.

A dialect names its reference tag, encoding and clean-ups, and the tags of each field in order of preference. `shape`
is a hook that gets the tree and the fields found so far and changes what the tags alone do not tell.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

import regex as re

from . import base as B
from .xml_core import Node

Rules = list[tuple[str, str]]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
THESIS = r"(?i)(thesis|dissertation)"


@dataclass(frozen=True)
class Names:
    """How authors are told: elements that hold a name each, and the tags of its parts."""

    holders: tuple = ("person-group[author]", "name", "string-name")
    last: str = "surname"
    first: str = "given-names"
    groups: tuple = ("collab",)
    editors: tuple = ()
    plain: tuple = ()  # elements whose whole text is a name


@dataclass(frozen=True)
class Dialect:
    name: str
    tag: str
    encoding: str = "UTF-8"
    names: Names = Names()
    year: tuple = ("year",)
    journal: tuple = ("source",)
    title: tuple = ("article-title", "chapter-title")
    volume: tuple = ("volume",)
    page: tuple = ("fpage",)
    issue: tuple = ()
    issn: tuple = ()
    series: tuple = ()
    doi: tuple = ("pub-id[doi]",)
    arxiv: tuple = ()
    text: tuple = ()  # where the plain text is if no citation can be made; empty: the whole reference
    arxiv_prefix: str = ""
    find_arxiv: bool = True  # look for identifiers in the text
    find_doi: bool = True
    letters: str = ""
    raw_volume: bool = False
    plain_only: bool = False
    block_rules: Rules = field(default_factory=list)
    rules: Rules = field(default_factory=list)
    shape: Callable[[Node, dict, Dialect], dict] | None = None
    split: Callable[[str], list[str]] | None = None
    carry: str = ""  # pattern of what a reference takes from the one before, see carry_over()


def _pick(node: Node, where: tuple) -> str:
    """The first text of tags; `tag[value]` asks for a type attribute of that value, `tag@name` for an attribute."""
    for w in where:
        if m := re.fullmatch(r"([\w-]+)\[(\w[\w-]*)\]", w):
            t = next((node._text(e) for e in node.root.iter(m[1]) if m[2] in (e.get("pub-id-type"), e.get("type"), e.get("person-group-type"), e.get("content-type"), e.get("link-type"), e.get("specific-use"), e.get("ext-link-type")) and node._text(e)), "")
        elif "@" in w:
            t = node.attribute(*w.split("@"))
        else:
            t = node.text(w)
        if t:
            return t.strip()
    return ""


def _names(node: Node, n: Names) -> str:
    out: list[str] = []
    for holders in (n.holders, n.editors):
        for h in holders:
            if m := re.fullmatch(r"([\w-]+)\[(\w+)\]", h):
                groups = [g for g in node.within(m[1]) if m[2] in (g.root.get("person-group-type"), None)]
                found = [x for g in groups for x in (g.within("name") or g.within("string-name") or [g])]
            else:
                found = node.within(h)
            for x in found:
                last, first = x.text(n.last), x.text(n.first) if n.first else ""
                if last:
                    out.append(f"{last}, {first}" if first else last)
                elif first:
                    out.append(first)
            if out:
                break
        if out:
            break
    if not out:
        out = [t for p in n.plain for t in node.texts(p)]
    return ", ".join([t for g in n.groups for t in node.texts(g)] + out)


def parse_reference(text: str, d: Dialect) -> dict:
    """The fields of one reference; raises ValueError if there is nothing to parse."""
    from .xml_core import parse

    if not text.strip():
        raise ValueError("an empty reference")
    node = parse(B.rewrite(text, d.rules))
    whole = node.whole()
    if d.plain_only:
        out = B.record(doi=B.match_doi(whole) if d.find_doi else None, arxiv=B.match_arxiv_id(whole) if d.find_arxiv else None, refplaintext=B.plain_text(B.to_ascii(whole)))
        return d.shape(node, out, d) if d.shape else out
    f = {
        "authors": re.sub(r"__amp;?", "", _names(node, d.names)), "year": _pick(node, d.year) or B.match_year(whole), "journal": _pick(node, d.journal), "title": _pick(node, d.title),
        "volume": _pick(node, d.volume), "page": _pick(node, d.page), "issue": _pick(node, d.issue), "issn": _pick(node, d.issn), "series": _pick(node, d.series),
    }
    told = _pick(node, d.doi)
    f["doi"] = told or (B.match_doi(whole) if d.find_doi else None)
    told = B.match_arxiv_id(_pick(node, d.arxiv)) if d.arxiv else None
    told = told or (B.match_arxiv_id(whole) if d.find_arxiv else None)
    f["arxiv"] = d.arxiv_prefix + told if told else None
    f["_whole"] = whole
    if d.shape:
        f = d.shape(node, f, d)
    if not d.raw_volume:
        f["volume"] = B.parse_volume(f.get("volume"))
    if not f.pop("_page_done", False):
        f["page"] = B.page_with_letter(f.get("page"), letters=d.letters)
    f.pop("_whole", None)
    f["refstr"] = f.get("refstr") or B.reference_string(f)
    if not f["refstr"] and not f.get("refplaintext"):
        f["refplaintext"] = B.plain_text(B.to_ascii(_pick(node, d.text) or whole))
    return B.record(**f)


def carry_over(previous: str, current: str, pattern: str, placeholder: str = r"-{3,}") -> str:
    """A placeholder as what the pattern finds in the reference before."""
    m = re.search(pattern, previous or "", flags=re.S)
    return re.sub(placeholder, lambda _: m[0], current) if m and re.search(placeholder, current) else current


# Peculiarities -------------------------------------------------------------


def _aas(node: Node, f: dict, d: Dialect) -> dict:
    told = (node.root.get("URI") or node.attribute("CITATION", "BIBCODE")).replace("__amp__", "&")
    return f | ({"bibcode": told} if len(told) == 19 else {})


def _agu(node: Node, f: dict, d: Dialect) -> dict:
    f = {k: None if v == "null" else v for k, v in f.items()}
    number = node.text("CitationNumber")
    letter = ""
    if not f["page"] and number and number != "null":
        f["page"], letter = number[0] + number, number[0]
    f["journal"] = f["journal"] or node.text("reftitle")
    if m := re.match(r"([ABCDE])\d+", f["issue"] or ""):
        f["journal"] = f"{f['journal']} {m[1]}"
    if letter:
        f["journal"] = f"{f['journal']} {letter}"
    f["authors"] = node.text("first_author")
    texts = [node._text(c) for c in node.root if node._text(c).lower() not in ("", "null")]
    return f | {"_page_done": True, "_plain": ", ".join(texts), "doi": (f["doi"] or "").replace("&lt;", "<").replace("&gt;", ">")}


def _aip(node: Node, f: dict, d: Dialect) -> dict:
    names = []
    for a in (node.within("biaugrp") or node.within("editor"))[:1]:
        for x in a.within("biauth"):
            last, first = x.text("bilname"), x.text("bifname")
            if last:
                names.append(f"{last}, {first[0]}." if first else last)
    title = f["title"] or next((t for t in node.texts("emph_1") if t.count(" ") > 1), "")
    return f | {"authors": ", ".join(names), "title": title}


def _aps(node: Node, f: dict, d: Dialect) -> dict:
    def turn(name: str) -> str:
        parts = B.to_ascii(name).split()
        if "," in name or len(parts) < 2:
            return B.to_ascii(name).strip()
        first = [parts.pop(0)]
        while len(parts) > 1 and re.fullmatch(r"\w\.", parts[0]):
            first.append(parts.pop(0))
        return " ".join(parts + first)

    names = node.texts("refauth") or node.texts("editor")
    series = re.match(r"(([A-Za-z\s.-]+)(Vol|No)\.?\s*\d+)", node.text("series"))
    told, date = B.url_decode(node.text("doi")), node.text("date")
    eprint = node.text("eprintid")
    found_doi, found_eprint = B.match_doi(f["_whole"]), B.match_arxiv_id(f["_whole"])
    return f | {"authors": ", ".join(map(turn, names)), "journal": f["journal"] or (series[0] if series else ""), "year": date[:4] if len(date) >= 4 else f["year"], "doi": told or (f"doi:{found_doi}" if found_doi else None), "arxiv": eprint or (f"arXiv:{found_eprint}" if found_eprint else None)}


def _pipes(prefix: str):
    """Fields in an attribute, between bars: journal, authors, volume, issue, page and year are the third to eighth."""

    def shape(node: Node, f: dict, d: Dialect) -> dict:
        parts = [p.strip() for p in node.attribute("bibliomisc", "id").replace("__amp__", "&").replace("&amp;", "&").split("|")]
        link = next((e for e in node.all("ulink")), None)
        eprint = node._text(link) if link is not None and link.get("Type") == "arXiv" else ""
        out = dict.fromkeys(f) | {"_whole": f["_whole"], "arxiv": prefix + eprint if eprint else None, "refstr": f["_whole"] or None}
        if len(parts) >= 8:
            out |= {"journal": parts[2], "authors": parts[3], "volume": parts[4], "page": parts[6], "year": parts[7]}
        return out

    return shape


def _blackwell(node: Node, f: dict, d: Dialect) -> dict:
    kind = node.root.get("type") or node.attribute("reference", "type")
    f["arxiv"] = next((a for a in map(B.match_arxiv_id, [*(node._text(e) for t in ("url", "astro-ph") for e in node.all("externallink", type=t)), node.text("miscellaneoustext")]) if a), f["arxiv"])
    f["bibcode"] = next((b for b in (re.sub("__amp__|%26", "&", node.attribute_where(t, {a: "ads"}, i)) for t, a, i in (("externallink", "type", "id"), ("extlink", "linktype", "linkid"))) if len(b) == 19), None)
    f["doi"] = node.attribute_where("externallink", {"type": "doi"}, "id") or node.attribute_where("extlink", {"linktype": "doi"}, "linkid") or f["doi"]
    f["year"] = node.attribute("date", "date") or node.attribute("cd", "year") or f["year"]
    if not kind:
        return f
    titles = node.attribute_texts("title", "type")
    book = [v for k, v in titles.items() if k.startswith(("boo", "do")) or k == "thesis"]
    paper = [v for k, v in titles.items() if k.startswith(("jou", "abb"))]
    if len(titles) == 1:
        only = next(iter(titles.values()))
        f["title"], f["journal"] = (only, "") if kind.startswith(("boo", "do")) or kind == "thesis" else ("", only)
    else:
        f["title"], f["journal"] = (book or [""])[0], (paper or [""])[0]
    if not f["title"] and not f["journal"]:
        f["journal"] = node.text("thesis") if kind == "thesis" else next((v for k, v in titles.items() if k.startswith("co")), "")
    f["volume"] = f["volume"] or B.parse_volume(node.own_text("title"))
    return f


def _crossref(node: Node, f: dict, d: Dialect) -> dict:
    names = ", ".join(map(B.format_authors, node.texts("author")))
    page = f["page"].replace(",", "")
    if page and "A" <= page[-1] <= "Z":
        page = page[-1] + page[:-1]
    journal = {"AA": "A&A", "NAT": "Natur"}.get(f["journal"], f["journal"])
    plain = re.sub(r"\s+", " ", node.text("unstructured_citation")).strip()
    return f | {"authors": names, "page": page, "journal": journal, "year": B.match_int(node.text("cYear")) or f["year"], "volume": B.match_int(f["volume"]), "refplaintext": None, "_plain": plain}


def _cup(node: Node, f: dict, d: Dialect) -> dict:
    kind = node.attribute("citation", "citation-type") or node.attribute("citation", "publication-type")
    if kind == "book":
        return f | {"title": node.text("chapter-title"), "volume": ""}
    if kind == "thesis":
        rest = re.sub(r"(<name.*</name>|<year.*</year>)", "", node.markup())
        m = re.search(r"[A-Z].*$", B.strip_tags(rest))
        return f | {"journal": re.sub(r"\s+", " ", m[0]).strip() if m else "Thesis", "title": "", "volume": "", "page": ""}
    if kind == "confproc":
        return f | {"journal": node.text("series") or f"in {node.text('conf-name')}", "title": "", "volume": ""}
    return f if kind == "journal" else f | {"title": ""}


def _elsevier(node: Node, f: dict, d: Dialect) -> dict:
    host = next(iter(node.within("host")), None)
    journal = host.text("maintitle") if host else ""
    volume = re.sub(r"[Vv]ols?\.\s+", "", f["volume"])
    if not volume or len(volume.split()) > 1:
        journal = ""
    if re.fullmatch(r"[IVXLCDM]+", volume):
        volume = str(B.roman_to_int(volume))
    names = next((n for tag in ("authors", "editors") for g in node.within("contribution") for n in [_names(Node(next(iter(g.root.iter(tag)), g.root)), Names((tag[:-1],), "surname", "given-name", ()))] if n), "")
    comment, page, issue = node.text("comment"), f["page"], node.text("issue-nr")
    done = False
    if re.search(r"Phys\. Rev", journal) and comment and not page:
        page, done = re.sub(r"\(.*", "", comment), True
    if re.search(r"(J\. Geophys\. Res|Geophys\. Res\. Lett\.)", journal) and page == "1" and len(issue) == 6 and issue[0] in "ABCDE":
        journal, page, done = f"{journal} {issue[0]}", issue[1:], True
    groups = node.texts("collaboration")
    return f | {"journal": journal, "title": f["title"] if f["title"] != journal else "", "volume": volume, "page": page, "_page_done": done, "authors": ", ".join([*groups, *([names] if names else [])]), "_plain": node.text("textref")}


def _icarus(node: Node, f: dict, d: Dialect) -> dict:
    edition, organisation = node.text("EDITION"), node.text("ORGNAME")
    return f | {"title": f"{f['title']}{edition} Ed." if edition and f["title"] else f["title"], "authors": ", ".join(x for x in (organisation, f["authors"]) if x)}


def _iop(node: Node, f: dict, d: Dialect) -> dict:
    names = node.text("ref_authors").replace("-", "")
    part, sci = node.text("ref_part"), f["journal"] == "Sci"
    f |= {"authors": names if re.search(r"\w{3,}", names) else "", "volume": f["issue"] if f["year"] == f["volume"] and f["issue"] else f["volume"], "issue": None, "journal": f"{f['journal']} {part}" if part else f["journal"]}
    if sci and f["doi"] and not f["doi"].replace("10.1126/science.", "").isdigit():
        f["doi"] = None
    return f


def _iopft(node: Node, f: dict, d: Dialect) -> dict:
    link = node.attribute("ext-link", "href")
    eprint = B.match_arxiv_id(link) or B.match_arxiv_id(f["_whole"])
    after = re.search(r"<source\s*/>([^,<]*)", node.markup())
    journal = f["journal"] or (after[1].strip() if after else node.text("conf-name"))
    bib = next((b for b in (_pick(node, ("ext-link[bibcode]",)), _pick(node, ("pub-id[ads]",))) if len(b) == 19), None)
    return f | {"journal": journal, "doi": _pick(node, ("pub-id[doi]",)) or B.match_doi(link) or f["doi"], "arxiv": f"arXiv:{eprint}" if eprint else None, "bibcode": bib}


def _jats(node: Node, f: dict, d: Dialect) -> dict:
    kind = node.root.get("publication-type") or node.attribute("mixed-citation", "publication-type") or "other"
    source, chapter, paper = node.text("source"), node.text("chapter-title"), node.text("article-title")
    if kind in ("book", "proc"):
        f["title"], f["journal"] = (chapter, source) if chapter and source else (source or chapter or paper, "")
    elif kind == "confproc":
        named = node.texts("conf-name")
        f["title"], f["journal"] = (named[0], named[1]) if len(named) > 1 else ("", named[0] if named else "")
        f["journal"], f["title"] = f["journal"] or source, f["title"] or paper
        f["year"] = f["year"] or B.match_year(node.text("conf-date"))
    else:
        f["title"], f["journal"] = paper, source
    if not f["journal"] and not f["title"]:
        italic = node.text("italic")
        said = re.search(r":\s*([^.(<_/][A-Za-z.\s]+)[.,(<_/]+", f["_whole"])
        f["journal"], f["title"] = italic, said[1].strip() if said else ""
    f["page"] = f["page"] or node.text("page-range")
    links = [unquote(e.get("href")) for e in node.root.iter("ext-link") if e.get("href")]
    asked = [m for link in links if (m := re.match(r'https?://inspirehep\.net/search\?p=find\+(J|doi|EPRINT)[\s+]*"?(.*?)"?$', link))]
    for m in asked:
        if m[1] == "doi":
            f["doi"] = f["doi"] or B.match_doi(m[2])
        elif m[1] == "EPRINT" and not f["arxiv"] and (e := B.match_arxiv_id(m[2])):
            f["arxiv"] = f"arXiv:{e}"
        elif m[1] == "J" and not (f["journal"] and f["volume"] and f["page"]):
            parts = m[2].split(",")
            if len(parts) >= 3:
                f["journal"], f["volume"], f["page"] = parts[0].replace(".", ". ").strip(), parts[1], parts[2]
    quoted = re.search(r"(?:``|\"|“)(.+?)(?:''|\"|”)", f["_whole"])
    f["title"] = f["title"] or (quoted[1].rstrip(",") if quoted else "")
    return f


def _jstage(node: Node, f: dict, d: Dialect) -> dict:
    if node.attribute("Original", "lang") != "en":
        return f | {"authors": "", "journal": "", "refplaintext": None, "_plain": B.plain_text(""), "doi": None, "arxiv": None}
    return f | {"authors": node.text("CitAuthor"), "doi": None, "arxiv": None, "_page_done": True}


def _living(node: Node, f: dict, d: Dialect) -> dict:
    online, eid = node.text("onlineversion"), node.text("eid")
    eprint = B.match_arxiv_id(node.text("eprint")) or (re.sub(r"(?i)http://arxiv\.org/abs/", "", online).strip() if "arxiv" in online.lower() else "")
    if eid and not f["page"]:
        f["page"] = eid
    elif eid and not eprint:
        eprint = eid
    thesis = any(node.text(t) for t in ("mastersthesis", "phdthesis"))
    return f | {"authors": ", ".join(node.texts("author")) or node.text("editor"), "arxiv": eprint, "journal": f["journal"] or ("thesis" if thesis else ""), "bibcode": node.text("adsurl").split("/")[-1] or None}


def _university(raw_source: bool = False, series_volumes: bool = False, thesis_in_comment: bool = False):
    """The layouts with nlm citations: years without letters, conference or thesis as journal, volume and page from a comment."""

    def shape(node: Node, f: dict, d: Dialect) -> dict:
        comment, volume = node.text("comment"), re.sub(r"(?i)vol\.?", "", f["volume"]).strip()
        f["year"] = re.sub("[A-Za-z]", "", f["year"] or "")
        f["journal"] = re.sub(r"__amp;?", "&", f["journal"])
        if not f["journal"] and series_volumes:
            #: Two book series that are told by words only.
            for stem, said in (("ASPC", r"ASP Conf[.] Ser[.] Vol[.] (\d+)"), ("ASSL", r"Astrophysics and Space Science Library, Vol[.] (\d+)|Vol[.] (\d+) of Astrophysics and Space Science Library")):
                if m := re.search(said, f["_whole"]):
                    f["journal"], volume = stem, m[1] or m[m.lastindex]
                    break
        if not f["journal"]:
            thesis = re.search(THESIS, comment if thesis_in_comment else f["_whole"])
            f["journal"] = node.text("conf-name") or ((comment if thesis_in_comment else "Thesis") if thesis else "")
        kind = node.attribute("nlm-citation", "citation-type") or node.attribute("citation", "citation-type") or node.attribute("mixed-citation", "publication-type")
        if comment and kind in ("journal", "confproc") and not volume and not f["page"] and len(comment.split()) == 2:
            volume, f["page"] = comment.split()
        eprint = B.match_arxiv_id(_pick(node, ("pub-id[arxiv]", "elocation-id[arxiv]"))) or B.match_arxiv_id(f["_whole"])
        return f | {"volume": volume, "doi": B.match_doi(_pick(node, ("pub-id[doi]",))) or B.match_doi(comment) or f["doi"], "arxiv": f"arXiv:{eprint}" if eprint else None}

    return shape


def _nature(node: Node, f: dict, d: Dialect) -> dict:
    text = node.markup()
    said = re.search(r"(?P<volume>[A-Z]?\d+)[\s,]+(?P<page>[BHPL]?\d+)", re.sub(r"<[^>]*>", " ", re.sub(r"(?is)<(atl|btl|jtl|refau|cd)\b.*?</\1>", " ", text)))
    only = re.search(r"[Vv]ol(?:ume|\.)?\s*(\d+)", f["_whole"])
    et_al = re.search(r"(?i)\bet[.\s]*al[.\s]", f["_whole"])
    group = re.search(r"(?i)^(.*?(?:Collaboration|Consortium|Group|Team)\b.*?)(?=<atl>)", re.sub(r"^<\w+[^>]*>", "", text))
    names = f["authors"] or (B.strip_tags(group[1]).rstrip(".") if group else "")
    return f | {"authors": names + (" " + et_al[0].strip() if et_al and f["authors"] else ""), "volume": said["volume"] if said else only[1] if only else "", "page": said["page"] if said else ""}


def _nlm(node: Node, f: dict, d: Dialect) -> dict:
    told = B.match_doi(node.text("pub-id"))
    eprint = None
    if "preprint" in f["_whole"]:
        own = B.match_arxiv_id(node.text("pub-id"))
        eprint = f"arxiv:{own}" if own else B.match_arxiv_id(f["_whole"])
    return f | {"journal": re.sub(r"\bamp\b", "&", f["journal"]), "doi": f"doi:{told}" if told else B.match_doi(re.sub(r"(?i)doi[:/\s]*[^10]*(10\.)", r"doi:\1", f["_whole"])), "arxiv": eprint}


def _rsc(node: Node, f: dict, d: Dialect) -> dict:
    title = node.text("title")
    f["journal"], f["title"] = (title, "") if node.text("journalcit") else ("", title)
    if not title:
        f["journal"] = "".join(re.findall(r"(?i)(MS thesis|PhD Thesis|PhD|Ph\.D\.|Thesis|Dissertation|Doctoral)", f["_whole"])) or node.text("arttitle")
    if not f["authors"]:
        turned = []
        for name in node.texts("editor"):
            first = re.findall(r"\b\w\.", name)
            last = re.sub(r"\s\s+", " ", re.sub(r"\b\w\.", "", name)).strip("- ")
            if first and last:
                turned.append(f"{last}, {' '.join(first)}")
        f["authors"] = ", ".join(turned)
    return f | {"doi": B.match_doi(_pick(node, ("link[doi]",))) or f["doi"]}


def _spie(node: Node, f: dict, d: Dialect) -> dict:
    chapter, paper = node.text("chapter-title"), node.text("article-title")
    f["title"] = paper or chapter
    f["journal"] = f["journal"] or (chapter if paper else "")
    if not f["journal"] and not f["title"]:
        f["journal"] = "".join(re.findall(r"(?i)(MS thesis|PhD Thesis|Master's Thesis)", f["_whole"]))
    f["doi"] = B.match_doi(node.text("pub-id")) or B.match_doi(f["_whole"])
    if not f["volume"] or not f["page"]:
        said = re.match(r"[^A-Za-z]+([A-Za-z].*)$", f["_whole"]) or re.match(r"()(.*)", f["_whole"])
        numbers = re.findall(r"\d\w*", said[said.lastindex])
        for used in (f["year"], f["volume"], f["page"]):
            if used and used in numbers:
                numbers.remove(used)
        if len(numbers) == 1:
            f["volume"], f["page"] = f["volume"] or numbers[0], f["page"] or f"E{numbers[0]}"
    return f


def _springer(node: Node, f: dict, d: Dialect) -> dict:
    t = node.text
    kinds = {
        "BibArticle": (t("ArticleTitle"), t("JournalTitle"), t("BibArticleDOI")), "BibChapter": (t("ChapterTitle") or t("BookTitle"), t("BookTitle") if t("ChapterTitle") else t("SeriesTitle"), t("BibChapterDOI")),
        "BibBook": (t("BookTitle"), "", t("BibBookDOI")), "BibIssue": ("", t("JournalTitle"), ""),
    }
    title, journal, doi = next((v for k, v in kinds.items() if node.has(k)), ("", "", ""))
    if node.has("BibChapter") and not f["volume"]:
        f["volume"] = t("NumberInSeries")
    if not title:
        free = re.match(r"(?:[A-Z][a-z_;]+,\s+(?:[A-Z]\.\s?)+,?\s+(?:and\s+)?)+([^,]{20,}),(.*?),\s*\d{4}\b", f["_whole"])
        title = free[1].strip() if free else ""
    address = next((a for e in node.root.iter("RefTarget") if (a := e.get("Address") or "").startswith(("https://doi.org/", "10."))), "").replace("https://doi.org/", "").strip()
    handle = next((Node(e).text("Handle") for e in node.root.iter("Occurrence") if e.get("Type") == "DOI"), "")
    names = f["authors"] or t("InstitutionalAuthorName") or _names(node, Names(("BibEditorName",), "FamilyName", "Initials", ()))
    free = re.sub(r"^\s*\[[^\]]*\]\s*", "", t("BibUnstructured"))
    return f | {"authors": names, "title": title, "journal": journal, "doi": doi or address or handle or f["doi"], "arxiv": next((a for a in map(B.match_arxiv_id, node.texts("RefSource")) if a), f["arxiv"]), "_plain": re.sub(r"http\S+", "", free).split("[")[0].strip()}


def _ucp(node: Node, f: dict, d: Dialect) -> dict:
    if not f["journal"] and node.attribute("citation", "citation-type") == "thesis":
        rest = B.strip_tags(re.sub(r"(<person-group.*</person-group>|<year.*</year>)", "", node.markup()))
        m = re.search(r"[A-Z].*$", rest)
        f["journal"] = re.sub(r"\s+", " ", m[0]).strip() if m else "Thesis"
    if not f["journal"] and (told := node.text("pub-id")):
        m = re.search(r">,\s([^<>]*)<pub-id", node.markup())
        m = m and re.search(r"[A-Z].*$", m[1])
        f["journal"] = f"{m[0].strip()} {told}" if m else ""
    eprint = B.match_arxiv_id(node.text("pub-id")) or B.match_arxiv_id(f["_whole"])
    return f | {"journal": re.sub(r"__amp;?", "&", f["journal"]), "arxiv": f"arXiv:{eprint}" if eprint else None}


def _versita(node: Node, f: dict, d: Dialect) -> dict:
    said = node.text("mixed-citation")
    if not node.text("element-citation"):
        return dict.fromkeys(f) | {"_whole": f["_whole"], "_plain": B.plain_text(B.to_ascii(said or f["_whole"]))}
    if (not f["volume"] or not f["page"]) and (m := re.search(r"\sid\.\s+(\d{4})(.{2})", said or f["_whole"])):
        f["volume"], f["page"] = f["volume"] or m[1], f["page"] or f"E{m[2]}"
    return f | {"doi": B.match_doi(node.text("pub-id")) or B.match_doi(said)}


def _wiley(node: Node, f: dict, d: Dialect) -> dict:
    kind = node.root.get("type") or node.attribute("citation", "type")
    t = {k: node.text(k) for k in ("articleTitle", "chapterTitle", "journalTitle", "bookTitle", "bookSeriesTitle", "otherTitle")}
    series = ""
    if kind == "journal":
        title, journal = t["articleTitle"] or t["otherTitle"], t["journalTitle"].replace("amp;", "")
    elif kind == "book":
        title = "; ".join(dict.fromkeys(x for x in (t["articleTitle"], t["chapterTitle"]) if x)) or t["otherTitle"]
        journal, series = t["bookTitle"] or t["bookSeriesTitle"], t["bookSeriesTitle"] if t["bookTitle"] else ""
        f["volume"] = f["page"] = ""
    else:
        #: Which of the titles that are there is the title, and which the journal.
        pairs = [("otherTitle", "articleTitle"), ("bookTitle", "bookSeriesTitle"), ("chapterTitle", "bookSeriesTitle"), ("otherTitle", "bookSeriesTitle"), ("chapterTitle", "bookTitle"), ("otherTitle", "bookTitle"), ("chapterTitle", "otherTitle")]
        there = [k for k, v in t.items() if v]
        if len(there) == 1:
            title, journal = (t[there[0]], "") if there[0] in ("articleTitle", "chapterTitle", "journalTitle") else ("", t[there[0]])
        elif len(there) == 2:
            a, b = next((p for p in pairs if set(p) == set(there)), there)
            title, journal = t[a], t[b]
        elif len(there) == 3:
            if t["bookTitle"] and t["chapterTitle"]:
                title, journal, series = t["chapterTitle"], t["bookTitle"], t["bookSeriesTitle"] or t["otherTitle"]
            else:
                title, journal, series = (t[k] for k in there)
        else:
            title = journal = ""
    return f | {"title": title, "journal": journal, "series": series if re.fullmatch(r"[A-Za-z.\s]+", series) else None}


def _plain_then(shape):
    """`_plain` is the text of a reference that no citation can be made of."""

    def run(node: Node, f: dict, d: Dialect) -> dict:
        f = shape(node, f, d)
        plain = f.pop("_plain", None)
        if plain and not B.reference_string(f):
            f["refplaintext"] = plain
        return f

    return run


# The dialects --------------------------------------------------------------

_LINKS: Rules = [(r"\s+xlink:href=", " href="), (r'\s+xlink:type="[^"]*"', ""), (r"</?uri.*?>", "")]
_NO_EXT: Rules = [(r"</?(ext-link|x)\b.*?>", "")]
_FORMULA: Rules = [(r"(?s)<inline-formula.*?</inline-formula>", "")]
_SUBSUP: Rules = [(r"(?i)</?su[bp]>", "")]
_EDITED = replace(Names(), editors=("person-group[editor]",))
_PERSONS = r"<person-group.*</person-group>"


def _split_unstructured(text: str) -> list[str]:
    """Several references in one element, between semicolons, if each has its year; the year goes before the journal."""
    inner = re.sub(r"\s+", " ", B.entities_to_ascii(B.strip_tags(text)))
    items = [i.strip() for i in inner.split(";")]
    if len(re.findall(r"\(\d{4}[a-zA-Z]?\)", inner)) != len(items):
        items = [inner]
    moved = (re.sub(r"^([^:]*?):(.+)\((\d{4})[a-zA-Z]?\)(.*)$", r"\1 \3 \2 \4", i) for i in items if i)
    return [f"<BibUnstructured>{i.replace('&', '&amp;')}</BibUnstructured>" for i in moved]


ALL = [
    Dialect("AAS", "CITATION", plain_only=True, shape=_aas),
    Dialect("AGU", "citation", names=Names(()), journal=("journal_title",), title=("article_title",), page=("firstPage",), issue=("issue",), doi=("DOI",), text=("unstructured_citation",), find_arxiv=False, shape=_plain_then(_agu)),
    Dialect("AIP", "ref|refitem", names=Names(()), journal=("journal",), title=("bititle",), volume=("vol",), page=("pp",), doi=("linkkey_doi",), arxiv=("isskey_xxx",), shape=_aip,
            rules=[(r'<(\w+)\s+(?:loc|type)="(\w+)"([^>]*)/>', r"<\1_\2\3/>"), (r'<(\w+)\s+(?:loc|type)="(\w+)"(.*?)</\1>', r"<\1_\2\3</\1_\2>"), (r"<prevau\s*/?>", "---")], carry=r"<journal>.*?</journal>"),
    Dialect("AnA", "bibliomixed", shape=_pipes("arXiv:"), find_arxiv=False, find_doi=False),
    Dialect("APS", "ref|refitem", names=Names(()), journal=("jtitle", "journal"), title=("booktitle",), page=("pages",), issue=("issue",), issn=("issn",), text=("mixed-citation",), shape=_aps, rules=[(r"<formula.*?>.*?</formula>", ""), (r"<prevau\s*/?>", "---")], block_rules=[(r"</references>\s*$", "")], carry=r"<journal>.*?</journal>"),
    Dialect("BLACKWELL", "reference", names=Names(("name", "au"), "surname", "forenames", ("corporatename", "collab")), title=("atl", "tl"), journal=("jtl", "pubtl"), volume=("volume", "vid"), page=("page_first", "ppf"), doi=(), text=("reference",), raw_volume=True, shape=_blackwell,
            block_rules=[(r'<bb id="[\w]+">', "<reference>"), (r"</bb>", "</reference>"), *_SUBSUP, (r'(?i)<x xml:space="preserve">', ""), (r"<x>[^<]*</x>", ""), (r"(?i)<!-\s*not (present|supplied)\s*-?>?", ""), (r"<linkr.*?linkr>", ""), (r"</?snm>", lambda m: m[0].replace("snm", "surname")), (r"</?fnms>", lambda m: m[0].replace("fnms", "forenames"))]),
    Dialect("CrossRef", "citation", names=Names(()), year=("cYear",), journal=("journal_title", "series_title"), title=("article_title", "volume_title"), page=("first_page",), issue=("issue",), issn=("issn",), doi=("doi",), rules=[(r"<ref_issue>.*?</ref_issue>", "")], shape=_plain_then(_crossref)),
    Dialect("CUP", "citation", names=replace(Names(), holders=("name", "string-name")), title=("article-title",), raw_volume=True, shape=_cup, block_rules=[*_LINKS, (r"<private-char>.*?</private-char>", ""), (r"<inline-graphic.*?</inline-graphic>", "")]),
    Dialect("EDP", "bibliomixed", shape=_pipes(""), find_arxiv=False, find_doi=False),
    Dialect("EGU", "reference", plain_only=True, find_doi=False, find_arxiv=False, rules=[(r"\\doi10\.", "doi:10."), (r"doi:10\.", " doi:10.")], shape=lambda n, f, d: f | {"refplaintext": n.whole()}),
    Dialect("ELSEVIER", "reference", "ISO-8859-1", Names(()), year=("date",), journal=(), title=("title",), volume=("volume-nr",), page=("first-page", "article-number"), doi=("doi",), arxiv=("inter-ref",), letters=LETTERS, shape=_plain_then(_elsevier),
            block_rules=[(r"<(/?)[a-z]+:(.*?)>", r"<\1\2>"), (r"<(math|inter-ref|intra-ref).*?>", r"<\1>"), (r"<(/?)other-ref>", r"<\1reference>")]),
    Dialect("ICARUS", "CITATION", names=Names(("AUTHOR",), "SURNAME", "FNAME", ()), year=("DATE",), title=("TITLE", "BKTITLE"), journal=("SERTITLE", "SERIESTITLE"), volume=("VID", "CHAPTERNO"), page=("FPAGE", "PAGES"), find_doi=False, find_arxiv=False, raw_volume=True, shape=_icarus, rules=[(r'<AUTHOR TYPE="\w+">', "<AUTHOR>")]),
    Dialect("IOPFT", "ref", "ISO-8859-1", _EDITED, raw_volume=True, shape=_iopft, block_rules=_LINKS, rules=[(r'(?i)<img\s[^>]+\balt="([^"]+)".*?>', r"\1"), (r"<ref_issue>.*?</ref_issue>", ""), (r"(__amp__|&)#\d+;", ""), *_SUBSUP, (r"\[(\d+\.\d+)\]", r" arXiv:\1")]),
    Dialect("IOP", "reference", "ISO-8859-1", Names(()), year=("ref_year",), journal=("ref_journal",), title=("ref_item_title",), volume=("ref_volume",), page=("ref_start_page",), issue=("ref_issue",), issn=("ref_issn",), doi=("ref_doi", "pub-id[doi]"), arxiv_prefix="arXiv:", shape=_iop, rules=[(r'(?i)<img\s[^>]+\balt="([^"]+)".*?>', r"\1"), (r"(__amp__|&)#\d+;", ""), *_SUBSUP]),
    Dialect("IPAP", "BibUnstructured", plain_only=True, find_doi=False, find_arxiv=False, split=_split_unstructured, shape=lambda n, f, d: f | {"refplaintext": n.whole()}),
    Dialect("JATS", "mixed-citation", names=replace(Names(), holders=("string-name", "person-group[author]", "name")), issn=("issn",), doi=("pub-id[doi]",), arxiv=("pub-id[arxiv]",), arxiv_prefix="arXiv:", shape=_jats,
            block_rules=[(r"<object-id>.*?</object-id>", ""), *_FORMULA, (r"<disp-formula>.*?</disp-formula>", "")], rules=[*_LINKS, (r"\(<comment>.*?</comment>\)", ""), (r"<label>.*?</label>", "")]),
    Dialect("JSTAGE", "Citation", names=Names(()), year=("CitYear",), journal=("CitJournalName",), title=(), volume=("CitVol",), page=("CitFirstPage",), text=("Original",), shape=_plain_then(_jstage)),
    Dialect("LivingReviews", "record", names=Names(()), journal=("journal",), title=("title", "booktitle"), page=("pages",), series=("series",), doi=("doi",), find_doi=False, find_arxiv=False, raw_volume=True, shape=_living, block_rules=[(r"<(/?)[a-z]+:(.*?)>", r"<\1\2>")]),
    Dialect("MDPI", "ref", "ISO-8859-1", series=("series",), letters=LETTERS, shape=_university(thesis_in_comment=True), carry=_PERSONS, block_rules=[*_NO_EXT, *_LINKS, (r"<article-title>.*?</article-title>", ""), *_FORMULA, (r"<(/?)mml:", r"<\1"), (r"\s+", " ")], rules=[(r"[^\x00-\x7F]", "")]),
    Dialect("NATURE", "reftxt|REFTXT", names=Names(("refau",), "snm", "fnm", ()), year=("cd",), title=("atl", "btl"), journal=("jtl",), volume=(), page=(), doi=("refdoi",), text=("reftxt",), raw_volume=True, shape=_nature, rules=[(r"</?[A-Z]+(?=[\s>])", lambda m: m[0].lower())]),
    Dialect("NLM", "ref", names=_EDITED, shape=_nlm, text=("mixed-citation", "nlm-citation"), block_rules=[(r"</?uri.*?>", "")], rules=[*_NO_EXT, *_LINKS, *_FORMULA]),
    Dialect("ONCP", "bibtext", plain_only=True, find_doi=False, find_arxiv=False, rules=[(r"(?i)(&lt;|<)/?(I|B|EM|STRONG|DT|DD|TT|SUB|SUP)(&gt;|>)", ""), (r"&nbsp;", " ")], shape=lambda n, f, d: f | {"refplaintext": B.to_ascii(n.whole())}),
    Dialect("OUPFT", "ref", "ISO-8859-1", title=("article-title", "chapter-title", "bookTitle"), series=("series",), letters=LETTERS, shape=_university(series_volumes=True), carry=_PERSONS, block_rules=[*_NO_EXT, *_LINKS, (r"<etal\s*/>", "<surname>et al.</surname>")], rules=_FORMULA),
    Dialect("OUP", "ref", "ISO-8859-1", title=("article-title", "chapter-title", "bookTitle"), series=("series",), raw_volume=True, shape=_university(series_volumes=True), carry=_PERSONS, block_rules=[*_NO_EXT, *_LINKS, (r"<etal\s*/>", "<surname>et al.</surname>")], rules=_FORMULA),
    Dialect("PASA", "ref", "ISO-8859-1", Names(("person-group[author]", "name"), groups=("collab",)), journal=("jtitle", "source"), title=("article-title", "atitle", "btitle"), page=("fp", "fpage"), series=("series",), block_rules=[(r"\s+", " "), *_LINKS], rules=[(r"<(/?)authorgroup>", r"<\1name>"), (r"<(/?)sname>", r"<\1surname>"), (r"<(/?)firstname>", r"<\1given-names>")]),
    Dialect("RSC", "citgroup", names=Names(("citauth",), "surname", "fname", ()), volume=("volumeno",), issue=("issue",), arxiv_prefix="arXiv:", text=("citgroup",), shape=_rsc, block_rules=[(r"</?uri.*?>", ""), *_SUBSUP, (r"(?i)</?(it|bo)>", "")]),
    Dialect("SPIE", "ref", names=_EDITED, issue=("issue",), shape=_spie, block_rules=[(r"\(<comment>.*?</comment>\)", ""), *_NO_EXT, *_LINKS], rules=[(r"(__amp__|&)quot;", '"')]),
    Dialect("SPRINGER", "Citation", names=Names(("BibAuthorName",), "FamilyName", "Initials", ()), year=("Year",), journal=(), title=(), volume=("VolumeID",), page=("FirstPage",), doi=(), shape=_plain_then(_springer)),
    Dialect("UCP", "ref", names=_EDITED, journal=("source", "series", "conf-name"), title=("article-title", "chapter-title", "title"), series=("series",), raw_volume=True, shape=_ucp, carry=_PERSONS, block_rules=[(r"</?uri.*?>", ""), (r"&mdash;", "")], rules=[*_NO_EXT, *_LINKS, *_FORMULA, *_SUBSUP]),
    Dialect("VERSITA", "ref", names=_EDITED, text=("mixed-citation",), shape=_plain_then(_versita), block_rules=[*_LINKS, (r"\(<comment>.*?</comment>\)", ""), *_NO_EXT, *_FORMULA], rules=[(r"</?italic>", "")]),
    Dialect("WILEY", "citation", names=Names(("author", "editor"), "familyName", "givenNames", ("groupName",)), year=("pubYear",), journal=(), title=(), volume=("vol",), page=("pageFirst",), doi=(), letters=LETTERS, text=("citation",), shape=_wiley, block_rules=[(r"</?uri.*?>", ""), (r"xml:id", "xmlid")]),
]
DIALECTS = {d.name: d for d in ALL}
