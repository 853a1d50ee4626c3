"""Scalar functions of the engine as Column expressions: they stay in whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import QUEUED_BIBCODE, QUEUED_SCORE, UNRESOLVED

#: The subject classes of old arXiv identifiers.
ARXIV_CLASSES = (
    "acc-phys adap-org alg-geom ao-sci astro-ph atom-ph bayes-an chao-dyn chem-ph cmp-lg comp-gas cond-mat cs dg-ga funct-an gr-qc hep-ex hep-lat hep-ph hep-th math math-ph mtrl-th nlin nucl-ex nucl-th patt-sol physics plasm-ph q-alg q-bio quant-ph solv-int supr-con"
).split()
#: What identifiers, years and numbers look like in citations.
ARXIV_OLD = r"(?i)\b(?:arXiv\W*)?(" + "|".join(ARXIV_CLASSES) + r")(?:\.[A-Z]{2})?/(\d{7})(?::?v\d+)?\b"
ARXIV_NEW = r"(?i)\b(?:arXiv\s*\W?\s*|(?:" + "|".join(ARXIV_CLASSES) + r")\s*[:/]?\s*|http://.*?/abs/|)(\d{4})\.(\d{4,5})(?:v\d+)?\b"
DOI_PATTERNS = (r"(?i)\bdoi:\s*(10\.[\d.]{2,9}/\S+\w)", r"(?i)<doi>(10\.[\d.]{2,9}/\S+)</doi>", r'(?i)//(?:dx\.)?doi\.org/(10\.[\d.]{2,9}/[^<\s."]*)', r"(?i)\b(10.[\d.]{2,9}/\S+\w)")
YEAR = r"\b[12][09]\d\d[a-z]?\b"
YEAR_IN_PARENTHESES = r"\(.*([12][09]\d\d).*\)"
ROMAN = r"^(M{0,4}(?:CM|CD|D?C{0,3})?(?:XC|XL|L?X{0,3})?(?:IX|IV|V?I{0,3})?)$"
ROMAN_VALUES = {"M": 1000, "CM": 900, "D": 500, "CD": 400, "C": 100, "XC": 90, "L": 50, "XL": 40, "X": 10, "IX": 9, "V": 5, "IV": 4, "I": 1}
INCOMPLETE = " --- Incomplete"


def nonempty(c: Column) -> Column:
    """The value, null if it is empty."""
    return F.when(c != "", c)


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """What a group matches first, null without a match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def rewrite(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Ordered (pattern, replacement) pairs, one projection for all."""
    return reduce(lambda x, rule: F.regexp_replace(x, *rule), rules, c)


# Identifiers ---------------------------------------------------------------


def match_year(c: Column) -> Column:
    """The one year of a text; of several different ones, that in parentheses; else null."""
    years = F.array_distinct(F.regexp_extract_all(c, F.lit(f"({YEAR})"), F.lit(1)))
    return F.when(F.size(years) == 1, years[0]).when(F.size(years) > 1, first_match(c, YEAR_IN_PARENTHESES))


def match_doi(c: Column) -> Column:
    return F.coalesce(*(first_match(c, p) for p in DOI_PATTERNS))


def match_arxiv_id(c: Column) -> Column:
    old = F.concat(F.regexp_extract(c, ARXIV_OLD, 1), F.lit("/"), F.regexp_extract(c, ARXIV_OLD, 2))
    new = F.concat(F.regexp_extract(c, ARXIV_NEW, 1), F.lit("."), F.regexp_extract(c, ARXIV_NEW, 2))
    return F.when(c.rlike(ARXIV_OLD), old).when(c.rlike(ARXIV_NEW), new)


def match_int(c: Column) -> Column:
    return first_match(c, r"(\d+)")


def bib_year(c: Column) -> Column:
    return F.substring(c, 1, 4)


def bib_bibstem(c: Column) -> Column:
    return F.substring(c, 5, 5)


def is_bibcode(c: Column) -> Column:
    return F.length(c) == 19


def is_unresolved(c: Column) -> Column:
    return c == UNRESOLVED


def is_queued(bibcode: Column, score: Column) -> Column:
    return (bibcode == QUEUED_BIBCODE) & (score == QUEUED_SCORE)


def bibstem_mask(bibcode: Column, stem: str) -> Column:
    """LIKE with any four characters before the stem and any ten after it."""
    return bibcode.like("_" * 4 + stem + "_" * 10)


def year_mask(bibcode: Column, year: str) -> Column:
    return bibcode.like(year + "_" * 15)


def journal_bibcode(year: Column, stem: str, volume: Column, page: Column, initial: Column, qualifier: Column | None = None) -> Column:
    """A 19-character bibcode: year, journal, volume and page right-aligned with dots, a qualifier, the author's initial."""
    return F.concat(year, F.lit(stem.ljust(5, ".")), F.lpad(volume, 4, "."), F.coalesce(qualifier, F.lit(".")) if qualifier is not None else F.lit("."), F.lpad(page, 4, "."), initial)


# Volumes and pages ---------------------------------------------------------


def parse_volume(c: Column) -> Column:
    """The first run of digits; else the whole text if it is a roman numeral; else empty."""
    return F.coalesce(first_match(c, r"(\d+)"), F.regexp_extract(c, ROMAN, 1), F.lit(""))


def parse_pages(c: Column, ignore: str = "", letters: str = "") -> Column:
    """struct(page, qualifier): the digits of a page and the letter L, A, S or one of `letters` that it carries."""
    head, tail = F.substring(c, 1, 1), F.substring(c, -1, 1)
    one_of = lambda chars: head.isin(*chars) if chars else F.lit(False)
    rest = c.substr(F.lit(2), F.length(c))
    butt = c.substr(F.lit(1), F.length(c) - 1)
    qualifier = F.when(head.isin("L", "A"), head).when(one_of(ignore), None).when(one_of(letters), head).when(F.upper(tail) == "S", "S").when(F.upper(head) == "S", "S")
    number = F.when(head.isin("L", "A") | one_of(ignore) | one_of(letters), rest).when(F.upper(tail) == "S", butt).when(F.upper(head) == "S", rest).otherwise(c)
    digits = F.regexp_extract(F.regexp_replace(number, r"\s", ""), r"(\d+)", 1)
    empty = c.isNull() | (c == "")
    return F.struct(F.when(empty, "").otherwise(digits).alias("page"), F.when(~empty, qualifier).alias("qualifier"))


def combine_page_qualifier(page: Column, qualifier: Column) -> Column:
    return F.concat(F.coalesce(qualifier, F.lit("")), F.coalesce(page, F.lit("")))


def roman_to_int(c: Column) -> Column:
    """The value of a roman numeral, null if it is none."""
    one = {k: v for k, v in ROMAN_VALUES.items() if len(k) == 1}
    value = F.create_map(*[F.lit(x) for kv in one.items() for x in kv])
    digits = F.transform(F.filter(F.split(F.upper(c), ""), lambda x: x != ""), lambda x: F.element_at(value, x))
    fold = F.aggregate(digits, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")), lambda a, x: F.struct((a["sum"] + x - F.when(a["last"] < x, 2 * a["last"]).otherwise(0)).alias("sum"), x.alias("last")))
    return F.when(F.upper(c).rlike(ROMAN) & (c != ""), fold["sum"])


def int_to_roman(c: Column) -> Column:
    """The roman numeral of 1 to 3999 (4000 with four M), null outside."""
    steps = F.array(*(F.struct(F.lit(k).alias("sign"), F.lit(v).alias("value")) for k, v in ROMAN_VALUES.items()))
    start = F.struct(F.lit("").alias("text"), c.cast("int").alias("left"))

    def step(state: Column, s: Column) -> Column:
        times = F.floor(state["left"] / s["value"]).cast("int")
        return F.struct(F.concat(state["text"], F.repeat(s["sign"], times)).alias("text"), (state["left"] - times * s["value"]).cast("int").alias("left"))

    return F.when((c >= 1) & (c <= 4000), F.aggregate(steps, start, step)["text"])


# Citation strings ----------------------------------------------------------


def reference_string(authors: Column, year: Column, journal: Column, title: Column, volume: Column, pages: Column, doi: Column, eprint: Column) -> Column:
    """The canonical citation: one of five forms by which fields there are, then DOI and e-print; without author and year, all fields if there is an identifier."""
    a, y, j, t, v, p, d, e = (nonempty(c) for c in (authors, year, journal, title, volume, pages, doi, eprint))
    has = lambda *cs: reduce(lambda x, z: x & z, (c.isNotNull() for c in cs))
    place = v.isNotNull() | p.isNotNull()
    known = d.isNotNull() | e.isNotNull()
    tail = F.concat(F.coalesce(F.concat(F.lit(", "), v), F.lit("")), F.coalesce(F.concat(F.lit(", "), p), F.lit("")), F.lit("."))
    head = F.concat(a, F.lit(", "), y)
    form = (
        F.when(has(j, t) & place, F.concat(head, F.lit(". "), j, F.lit(", "), t, tail))
        .when(has(j) & place, F.concat(head, F.lit(". "), j, tail))
        .when(has(j) & known, F.concat(head, F.lit(". "), j, F.lit(".")))
        .when(has(t), F.concat(head, F.lit(". "), t, tail))
        .when(known, F.concat(head, F.lit(".")))
    )
    form = F.when(has(a, y), form)
    marked = F.when(F.lower(e).contains("arxiv"), F.concat(F.lit(" "), e)).otherwise(F.concat(F.lit(" arXiv:"), e))
    whole = F.concat(form, F.coalesce(F.concat(F.lit(" doi:"), d), F.lit("")), F.coalesce(marked, F.lit("")))
    return F.coalesce(whole, F.when(known, F.concat_ws(", ", a, y, j, t, v, p, d, e)))


def reference_plain_text(c: Column) -> Column:
    """The text without URLs and with single spaces, marked as incomplete unless it has a word of three letters and a year or ordinal."""
    bare = F.trim(F.regexp_replace(c, r"http\S+", ""))
    sound = bare.rlike(r"(?U)\w{3,}") & bare.rlike(r"(?U)\b[12][098]\d\d\w?\b|\d+(st|nd|rd|th)+")
    return F.concat(F.regexp_replace(bare, r"\s+", " "), F.when(sound, "").otherwise(INCOMPLETE))


def strip_tags(c: Column, change: str = " ") -> Column:
    return F.trim(F.regexp_replace(c, r"<.*?>", change))


def extract_tag(c: Column, tag: str, keep_tag: bool = False, greedy: bool = False, fold_case: bool = False, attributes: bool = False, join: str = "") -> Column:
    """struct(rest, content) of the first element with a tag; content is null and rest the text without one."""
    body, extra = (".*" if greedy else ".*?"), ("[^>]*" if attributes else "")
    inner = f"<{tag}{extra}>({body})</{tag}>"
    pattern = ("(?i)" if fold_case else "") + (f"({inner})" if keep_tag else inner)
    content = first_match(c, pattern)
    whole = F.regexp_extract(c, ("(?i)" if fold_case else "") + f"({inner})", 1)
    place = F.call_function("locate", whole, c)
    rest = F.when(content.isNotNull(), F.concat(F.substring(c, F.lit(1), place - 1), F.lit(join), c.substr(place + F.length(whole), F.length(c)))).otherwise(c)
    return F.struct(F.coalesce(rest, F.lit("")).alias("rest"), content.alias("content"))


#: LaTeX marks that become plain text, in order.
LATEX_RULES = [
    (r"\\[\w\W]\{([A-Za-z])\}", "$1"), (r"\\&", "&"), (r"&amp;", "&"), (r"\samp\s", "&"), (r"(:?'')|(:?``)", ""), (r"\\[\^\"'`.~]", ""), (r"\\[vH]\s?", ""),
    (r"\\([clL])", ""), (r"\\[ ]", " "), (r"\{\\(it|bf|em) (.*?)\}", "$2"), (r"\\(textbf|textit|emph)\{(.*?)\}", "$2"), (r"\\(textbf|textit|emph|sl|bf) ", " "), (r"&#37;", " "), (r"[{}]", ""),
    (r"\\new(?:line|block)", " "), (r"\\etal", "et al."), (r"\\([i-])", "$1"), (r"\s\s+", " "),
]


def latex_to_text(c: Column, macros: dict[str, str] | None = None) -> Column:
    """TeX markup as plain text; macros (`\\apj` -> journal) are replaced first, longest first."""
    for macro in sorted(macros or {}, key=len, reverse=True):
        c = F.regexp_replace(c, rf"\Q{macro}\E\b", macros[macro].replace("\\", r"\\").replace("$", r"\$"))
    return F.trim(rewrite(c, LATEX_RULES))


def move_year(c: Column) -> Column:
    """`authors: journal (year) rest` as `authors year journal rest`."""
    return F.regexp_replace(c, r"^([^:]+):\s*(.*?)\s*\((\d{4})\)\s*(.*)$", "$1 $3 $2 $4")


# File names ----------------------------------------------------------------


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def source_type(c: Column) -> Column:
    """The kind of a source file by its last one or two extensions; no dot: null."""
    parts = F.split(basename(c), r"\.")
    last, before = F.lower(F.try_element_at(parts, F.lit(-1))), F.lower(F.try_element_at(parts, F.lit(-2)))
    return (
        F.when(~basename(c).contains("."), None)
        .when((last == "xml") & (F.size(parts) >= 3) & (F.length(before) > 1), F.concat(F.lit("."), before, F.lit(".xml")))
        .when((last == "txt") & (before == "ocr"), ".ocr.txt")
        .otherwise(F.concat(F.lit("."), last))
    )


def path_journal(c: Column) -> Column:
    """The directory two above the file, null if there is none."""
    return nonempty(F.try_element_at(F.split(F.regexp_replace(c, r"\\", "/"), "/"), F.lit(-3)))


def raw_subfamily(filename: Column, parser: Column, extension: Column | None = None, kind: Column | None = None) -> Column:
    """Which family a .raw file belongs to, by parser, journal directory and name; null for other files."""
    effective = F.coalesce(*(nonempty(c) for c in (kind, extension) if c is not None), source_type(filename))
    p, j, b = F.trim(F.coalesce(parser, F.lit(""))), F.trim(F.coalesce(path_journal(filename), F.lit(""))), F.lower(F.coalesce(basename(filename), F.lit("")))
    #: Fixed values: (family, parser, journal directory, end of the name), the first that holds counts.
    families = [("arxiv", "arXiv", "arXiv", None), ("ref_raw", "ThreeBibsTxt", None, ".ref.raw"), ("jlven_html", "JLVEnHTML", "JLVEn", None), ("pasj_html", "PASJhtml", "PASJ", None), ("pasp_html", "PASPhtml", "PASP", None), ("aas", "AAS", None, ".aas.raw"), ("icarus", "ICARUS", None, ".icarus.raw"), ("pthph", "PThPhTXT", "PThPh", None), ("pthps", None, "PThPS", None), ("adstxt", "ADStxt", "ADS", None)]
    found = F.when(effective.isNull() | (effective != ".raw"), None)
    for name, by_parser, by_journal, by_end in families:
        tests = [x for x in (p == by_parser if by_parser else None, j == by_journal if by_journal else None, b.endswith(by_end) if by_end else None) if x is not None]
        found = found.when(reduce(lambda x, y: x | y, tests), f"raw_{name}")
    return found.otherwise("raw_other")


def file_extension(c: Column) -> Column:
    """The last two dotted parts in lower case, else the last."""
    both = F.regexp_extract(basename(c), r".*(\..*?\.[a-z]+)$", 1)
    return F.coalesce(nonempty(both), F.concat(F.lit("."), F.element_at(F.split(basename(c), r"\."), -1)))


def classify_source(filename: Column, parser_extension: Column) -> Column:
    """The kind of a source file: the extension that its parser is registered for, else what the name tells."""
    return F.coalesce(nonempty(parser_extension), source_type(filename))


def result_filename(c: Column, folder: str = "resolved") -> Column:
    return F.concat(F.replace(c, F.lit("sources"), F.lit(folder)), F.lit(".result"))


def as_bool(c: Column) -> Column:
    return F.lower(F.trim(c)).isin("1", "true", "yes", "on", "active")


# Staging identifiers -------------------------------------------------------


def staged_id(history_id: Column, item_num: Column) -> Column:
    return F.concat(F.lit("H"), history_id.cast("string"), F.lit("I"), item_num.cast("string"))


def staged_parts(c: Column) -> Column:
    """struct(history_id, item_num) of an identifier, nulls if it is none."""
    pattern = r"^H(\d+)I(\d+)$"
    return F.struct(first_match(c, pattern, 1).cast("long").alias("history_id"), first_match(c, pattern, 2).cast("int").alias("item_num"))
