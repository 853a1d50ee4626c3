import pytest
from pyspark.sql import functions as F

from refloom.parse import base as B
from refloom.parse import parse_blocks, parse_files
from refloom.parse.dialects import DIALECTS, parse_reference
from refloom.parse.registry import ALIASES, PARSERS, parser_for
from refloom.parse.text import FORMATS
from refloom.parse.xml_core import elements, parse

BIB = "2020A&A...640A..49Z"


def test_thirty_one_dialects_and_all_text_formats():
    assert len(DIALECTS) == 31 and len(FORMATS) == 21 and len(PARSERS) == 52
    assert all(parser_for(a) for a in ALIASES)


@pytest.mark.parametrize(
    ("dialect", "text", "want"),
    [
        ("CrossRef", '<citation key="1"><journal_title>AA</journal_title><author>J. Smith</author><volume>12</volume><first_page>345L</first_page><cYear>2001</cYear><doi>10.1000/x1</doi></citation>', {"journal": "A&A", "authors": "Smith J.", "page": "L345", "volume": "12", "year": "2001", "doi": "10.1000/x1", "refstr": "Smith J., 2001. A&A, 12, L345. doi:10.1000/x1"}),
        ("JATS", '<mixed-citation publication-type="journal"><name><surname>Doe</surname><given-names>A.-B.</given-names></name> <article-title>On X</article-title> <source>ApJ</source> <year>2010</year> <volume>7</volume> <fpage>L3</fpage> <pub-id pub-id-type="doi">10.1/abc</pub-id></mixed-citation>', {"title": "On X", "journal": "ApJ", "page": "L3", "doi": "10.1/abc"}),
        ("JATS", '<mixed-citation publication-type="book"><source>Big Book</source><chapter-title>Part</chapter-title><year>1999</year></mixed-citation>', {"title": "Part", "journal": "Big Book"}),
        ("NLM", '<ref><nlm-citation citation-type="journal"><person-group person-group-type="author"><name><surname>Roe</surname><given-names>B</given-names></name></person-group><year>2003</year><source>Nature</source><volume>4</volume><fpage>55</fpage></nlm-citation></ref>', {"authors": "Roe, B", "journal": "Nature", "refstr": "Roe, B, 2003. Nature, 4, 55."}),
        ("IOP", "<reference><ref_authors>Lee A</ref_authors><ref_year>1998</ref_year><ref_journal>CQG</ref_journal><ref_volume>1998</ref_volume><ref_issue>15</ref_issue><ref_start_page>S1</ref_start_page></reference>", {"volume": "15", "page": "S1", "journal": "CQG"}),
        ("APS", '<ref><refauth>B. C. Jones</refauth><jtitle>PRD</jtitle><volume>5</volume><pages>6</pages><date>20020101</date><doi>10.1%2Fx</doi></ref>', {"authors": "Jones B. C.", "year": "2002", "doi": "10.1/x"}),
        ("AIP", '<ref><biaugrp><biauth><bifname>Ann</bifname><bilname>Poe</bilname></biauth></biaugrp><journal>JAP</journal><vol>9</vol><pp>A10</pp><year>2001</year></ref>', {"authors": "Poe, A.", "page": "A10"}),
        ("SPRINGER", '<Citation><BibArticle><BibAuthorName><Initials>K</Initials><FamilyName>Mo</FamilyName></BibAuthorName><Year>2011</Year><ArticleTitle>T</ArticleTitle><JournalTitle>J</JournalTitle><VolumeID>3</VolumeID><FirstPage>8</FirstPage><Occurrence Type="DOI"><Handle>10.5/q</Handle></Occurrence></BibArticle></Citation>', {"authors": "Mo, K", "title": "T", "journal": "J", "doi": "10.5/q"}),
        ("ELSEVIER", "<reference><contribution><authors><author><given-name>A</given-name><surname>Zed</surname></author></authors><title>Work</title></contribution><host><maintitle>Icarus</maintitle><volume-nr>XIV</volume-nr></host><date>1971</date><first-page>12</first-page></reference>", {"authors": "Zed, A", "volume": "14", "journal": "Icarus"}),
        ("WILEY", '<citation type="journal"><author><familyName>Ng</familyName><givenNames>P.</givenNames></author><pubYear>1990</pubYear><journalTitle>JGR</journalTitle><vol>95</vol><pageFirst>B12</pageFirst></citation>', {"authors": "Ng, P.", "page": "B12", "journal": "JGR"}),
        ("WILEY", "<citation type=\"other\"><chapterTitle>C</chapterTitle><bookTitle>B</bookTitle><author><familyName>N</familyName></author><pubYear>1990</pubYear></citation>", {"title": "C", "journal": "B"}),
        ("BLACKWELL", '<reference type="journal"><name><surname>Oz</surname><forenames>F.</forenames></name><date date="1987"/><title type="journal">MNRAS</title><volume>2</volume><page_first>3</page_first><externallink type="ads" id="1987MNRAS...2....3O"/></reference>', {"authors": "Oz, F.", "journal": "MNRAS", "year": "1987", "bibcode": "1987MNRAS...2....3O"}),
        ("AGU", "<citation><first_author>Ray</first_author><journal_title>null</journal_title><reftitle>Book</reftitle><firstPage>null</firstPage><CitationNumber>A0101</CitationNumber><year>2004</year><volume>null</volume></citation>", {"authors": "Ray", "page": "AA0101", "journal": "Book A"}),
        ("NATURE", '<reftxt><refau><snm>Sun</snm><fnm>L.</fnm></refau> <atl>On Y</atl> <jtl>Nature</jtl> <vid>400</vid>, 20-22 (<cd year="1999">1999</cd>)</reftxt>', {"authors": "Sun, L.", "volume": "400", "page": "20", "year": "1999"}),
        ("ICARUS", "<CITATION><AUTHOR TYPE=\"x\"><FNAME>G</FNAME><SURNAME>Tan</SURNAME></AUTHOR><DATE>1985</DATE><SERTITLE>Icarus</SERTITLE><VID>60</VID><FPAGE>1</FPAGE></CITATION>", {"authors": "Tan, G", "volume": "60"}),
        ("RSC", "<citgroup><journalcit><citauth><fname>H</fname><surname>Uhr</surname></citauth><title>PCCP</title><year>2002</year><volumeno>4</volumeno><fpage>5</fpage><link type=\"doi\">10.1039/b1</link></journalcit></citgroup>", {"journal": "PCCP", "authors": "Uhr, H", "doi": "10.1039/b1"}),
        ("JSTAGE", '<Citation><Original lang="en">Vo (2000) EPS 1, 2</Original><CitAuthor>Vo</CitAuthor><CitJournalName>EPS</CitJournalName><CitYear>2000</CitYear><CitVol>vol 52</CitVol><CitFirstPage>7</CitFirstPage></Citation>', {"authors": "Vo", "volume": "52", "page": "7"}),
        ("JSTAGE", '<Citation><Original lang="ja">x</Original><CitAuthor>Vo</CitAuthor></Citation>', {"refplaintext": " --- Incomplete"}),
        ("AnA", '<bibliomixed>Wu 1990, A&amp;A 1, 2 <bibliomisc id="a|b|A&amp;A|Wu|1|3|2|1990"/><ulink Type="arXiv">1234.5678</ulink></bibliomixed>', {"journal": "A&A", "arxiv": "arXiv:1234.5678", "year": "1990"}),
        ("EDP", '<bibliomixed><bibliomisc id="a|b|ApJ|Wu|1|3|L2|1990"/></bibliomixed>', {"refstr": "Wu, 1990. ApJ, 1, L2."}),
        ("AAS", f'<CITATION URI="{BIB}">Xi 2001 ApJ 1 2 doi:10.1000/zz</CITATION>', {"bibcode": BIB, "doi": "10.1000/zz"}),
        ("EGU", r"<reference>Yi 2003 \doi10.1029/95</reference>", {"refplaintext": "Yi 2003 doi:10.1029/95"}),
        ("ONCP", "<bibtext>Zo &lt;I&gt;x&lt;/I&gt; 2001</bibtext>", {"refplaintext": "Zo x 2001"}),
        ("MDPI", "<ref><name><surname>Ab</surname><given-names>C</given-names></name><year>2011a</year><comment>PhD Thesis, MIT</comment></ref>", {"year": "2011", "journal": "PhD Thesis, MIT"}),
        ("OUP", "<ref><citation citation-type=\"journal\"><name><surname>Ac</surname><given-names>D</given-names></name><year>2005</year>ASP Conf. Ser. Vol. 33 <fpage>9</fpage></citation></ref>", {"journal": "ASPC", "volume": "33"}),
        ("OUPFT", "<ref><mixed-citation publication-type=\"journal\"><name><surname>Ad</surname></name><year>2005</year><source>MNRAS</source><comment>12 34</comment></mixed-citation></ref>", {"volume": "12", "page": "34"}),
        ("UCP", "<ref><citation citation-type=\"thesis\"><person-group person-group-type=\"author\"><name><surname>Ae</surname></name></person-group><year>1999</year> Ph.D. thesis, Univ. X</citation></ref>", {"journal": "Ph.D. thesis, Univ. X"}),
        ("SPIE", "<ref><mixed-citation publication-type=\"confproc\"><name><surname>Af</surname><given-names>E</given-names></name><source>Proc. SPIE</source> 7731 <year>2010</year></mixed-citation></ref>", {"volume": "7731", "page": "7731"}),
        ("VERSITA", "<ref><mixed-citation>Ag 2001</mixed-citation></ref>", {"refplaintext": "Ag 2001"}),
        ("PASA", "<ref><authorgroup><sname>Ah</sname><firstname>F</firstname></authorgroup><year>2001</year><jtitle>PASA</jtitle><volume>1</volume><fp>2</fp></ref>", {"authors": "Ah, F", "journal": "PASA"}),
        ("CUP", '<citation citation-type="journal"><name><surname>Ai</surname></name><year>2001</year><article-title>T</article-title><source>JFM</source><volume>1</volume><fpage>2</fpage></citation>', {"title": "T", "journal": "JFM"}),
        ("IOPFT", '<ref><name><surname>Aj</surname></name><year>2001</year><source/>ApJ, 1 <ext-link href="http://arxiv.org/abs/1501.00001"/></ref>', {"journal": "ApJ", "arxiv": "arXiv:1501.00001"}),
        ("LivingReviews", "<record><author>Ak</author><year>2001</year><phdthesis>x</phdthesis><eid>12</eid><adsurl>http://x/abs/2001LRR.....4....1A</adsurl></record>", {"journal": "thesis", "bibcode": "2001LRR.....4....1A", "page": "12"}),
    ],
)
def test_dialect_fields(dialect, text, want):
    got = parse_reference(text, DIALECTS[dialect])
    assert {k: got.get(k) for k in want} == want


def test_unstructured_split():
    d = DIALECTS["IPAP"]
    made = d.split("<BibUnstructured>A. Author: ApJ (2001) 3; B. Other: PRL (2002) 4</BibUnstructured>")
    assert [parse_reference(m, d)["refplaintext"] for m in made] == ["A. Author 2001 ApJ 3", "B. Other 2002 PRL 4"]


def test_broken_xml_is_mended():
    assert parse("<citation>a <883::AID-MASY883> b</citation>").whole() == "a b"
    assert "Smith" in parse("<citation>Smith <b>2001</citation>").whole()
    assert elements("<ref><ref>x</ref></ref><ref id='2'>y</ref><reference/>", "ref") == ["<ref><ref>x</ref></ref>", "<ref id='2'>y</ref>"]


def test_string_functions():
    assert [B.parse_volume(v) for v in ("12345", "XIV", "abc", "123XIV", "", "000123", "IIII")] == ["12345", "XIV", "", "123", "", "000123", ""]
    assert [B.int_to_roman(n) for n in (1, 4, 9, 14, 1994, 4000)] == ["I", "IV", "IX", "XIV", "MCMXCIV", "MMMM"] and B.roman_to_int("MCMXCIV") == 1994
    for bad in ("", "IIII", "abc"):
        with pytest.raises(ValueError):
            B.roman_to_int(bad)
    with pytest.raises(ValueError):
        B.int_to_roman(0)
    assert B.url_decode("a%20b%2Fc%zz") == "a b/c%zz"
    assert [B.match_int(x) for x in ("a12b3", "", None, ["x7"])] == ["12", None, None, "7"]
    assert B.match_year("1999, 2000 (2001)") == "2001" and B.match_year("see 1999a") == "1999a" and B.match_year("no") is None
    assert B.match_doi("x doi: 10.1000/ab.c, y") == "10.1000/ab.c" and B.match_doi("https://doi.org/10.1000/ab") == "10.1000/ab"
    assert B.match_arxiv_id("arXiv:1802.05161v2") == "1802.05161" and B.match_arxiv_id("astro-ph/0101001") == "astro-ph/0101001"
    assert B.parse_pages("L12") == ("12", "L") and B.parse_pages("12S") == ("12", "S") and B.parse_pages("e5", letters="e") == ("5", "e") and B.parse_pages("p5", ignore="p") == ("5", None) and B.parse_pages("") == ("", None)
    assert B.is_bibcode(BIB) and not B.is_bibcode("2020A&A")
    assert B.entities_to_ascii("&eacute;&#233;&#xe9; __amp__ &unknown;") == "eee & &unknown;" and B.to_entities("é") == "&eacute;"
    assert B.format_authors("I. Affleck, A. W. W. Ludwig and D. L. Cox et al.") == "Affleck I., Ludwig A. W. W., Cox D. L., et al."
    assert B.latex_to_text(r"{\it Nature} \& \textbf{5}, \apj", {r"\apj": "ApJ"}) == "Nature & 5, ApJ"
    assert FORMATS["ADStex"].clean(r"Smith, \apjl, 1; \adassxiv 3 \apjx") == r"Smith, ApJ, 1; Astronomical Data Analysis Software and Systems XIV 3 \apjx"
    assert B.item_number([4, 5], 1) == B.item_number([4, 5], -1) == {"item_num": 5} and B.item_number([], 0) == B.item_number([4], 3) == {}
    assert B.detect_format("<ADSBIBCODE>x") == "xml" and B.detect_format(r"\adsbibcode{x}") == "tex" and B.detect_format("%R x") == "tag" and B.detect_format("x") is None


def test_inheritance_and_acceptance():
    before = "Smith, J., and Johnson, A. (2019), A previous study on astrophysics, Astrophys. J., 99, 100-105."
    assert B.inherit("--- (2020), A study, J., 100.", before) == "Smith, J., and Johnson, A. (2020), A study, J., 100."
    assert B.inherit("--- , A study, J., 100.", before) == "Smith, J., and Johnson, A. , A study, J., 100."
    for now, prev in (("***** (2020), A study.", before), ("--- (2020), A study.", "Smith, J., A study, J., 99, 100, (2019)."), ("--- (2020), A study.", "Smith, J., A study, J., 99, 100, 2019."), ("Adams (2020), A.", before)):
        assert B.inherit(now, prev) == now
    chained = B.chain([before, "--- (2020), B.", "--- (2021), C."])
    assert all(c.startswith("Smith, J., and Johnson, A.") for c in chained)
    yes = [before, "Doe, J. et al., New, Nature, 67, 111, doi:10.1038/s41586-020-2055-7", "Adams, R., AI, 21(4), 101, arXiv:1802.05161", "Smith, J., and Johnson, A., A study, Astrophys. J., 99, 100-105."]
    assert all(map(B.is_reference, yes)) and not B.is_reference("This is not a valid reference") and not B.is_reference("Miller, L. et al. The role of black holes in galaxy formation")


FILES = [
    ("/s/arXiv/0/0.raw", "arXiv", "%R 0001arXiv.........Z\n%Z\n(1) Smith (2020), A, 1; (2) Doe (2021), B, 2.\n\n%R 0002arXiv.........Z\n%Z\n[1] Lee 2019 MNRAS, 3\n", [("0001arXiv.........Z", ["Smith (2020), A, 1", "Doe (2021), B, 2."]), ("0002arXiv.........Z", ["Lee 2019, MNRAS, 3"])]),
    ("/s/ATel/0/0.pairs", "PairsTXT", f"# c\n{BIB};1999ApJ...500....1A;said\n{BIB};1999ApJ...500....2B\n1999ApJ...500....3C\t2021A&A...640A..49Z\n", [(BIB, ["1999ApJ...500....1A;said", "1999ApJ...500....2B"]), ("2021A&A...640A..49Z", ["1999ApJ...500....3C"])]),
    (f"/s/ARA+A/0/{BIB}.ref.refs", "FlatTXT", "Title line\nSmith, J. (2019), A study, 1, 2\n--- (2020), Another, 3\n", [(BIB, ["Smith, J. (2019), A study, 1, 2", "Smith, J. (2020), Another, 3"])]),
    (f"/s/X/0/{BIB}.txt", "ARAnATXT", "% c\n1. Smith J 2019,\n ApJ 1\n2. Doe 2020\n", [(BIB, ["Smith J 2019, ApJ 1", "Doe 2020"])]),
    ("/s/PThPh/0/i.raw", "PThPhTXT", f"%R {BIB}\n%Z\n1 Smith, Phys. Rev. 12 (1990), 5; ibid. 13 (1991), 6\n", [(BIB, ["Smith, Phys. Rev. 12 (1990), 5", "Smith, Phys. Rev 13 (1991), 6"])]),
    (f"/s/Obs/0/{BIB}.ref.ocr.txt", "ObsOCR", "(1) A. Smith, ApJ, 1,\n2, 1990.\n(O2) B. Doe, 1991.\n", [(BIB, ["A. Smith, ApJ, 1, 2, 1990.", "B. Doe, 1991."])]),
    (f"/s/ADS/0/{BIB}.ref.ocr.txt", "ADSocr", "Smith, A. 1990,\nApJ, 1, 2\nDoe, B. 1991, PRL, 3, 4\n", [(BIB, ["Smith, A. 1990, ApJ, 1, 2", "Doe, B. 1991, PRL, 3, 4"])]),
    ("/s/ADS/0/i.tex", "ADStex", f"%R {BIB}\n%Z\n\\bibitem[a]{{b}} Smith {{\\it ApJ}}\n 1990\n\\bibitem{{c}} Doe 1991\n", [(BIB, ["Smith ApJ 1990", "Doe 1991"])]),
    (f"/s/A+A/0/{BIB}.ref.txt", "AnAhtml", "<UL><LI>Smith 1990 <IMG src=x><LI>Doe &eacute; 1991</UL>", [(BIB, ["Smith 1990", "Doe e 1991"])]),
    ("/s/PASP/0/i.raw", "PASPhtml", f"<ADSBIBCODE>{BIB}</ADSBIBCODE><CITATION ID='1'>Smith 1990</CITATION><CITATION ID='2'>Doe 1991</CITATION>", [(BIB, ["Smith 1990", "Doe 1991"])]),
    (f"/s/JLVEn/0/{BIB}.raw", "JLVEnHTML", '<TR><TD valign="top">Smith 1990</TD></TR>', [(BIB, ["Smith 1990"])]),
    ("/s/AEdRv/0/0.html", "AEdRvHTML", '<p class="author">by <strong>Ann Lee, X</strong><p id="biblio-cite">Y, The Astronomy Education Review, Issue 2, Volume 3:44-50, 2005<p class="reference">Smith <em>1990</em></p>', [("2004AEdRv...3b..44L", ["Smith 1990"])]),
    ("/s/AREPS/0/annurev.x.html", "AREPSHTML", "(doi:10.1146/a) <nobr>Smith 1990 <script>genRefLink(1, 2, '10.1%2Fb')</script>", [("1999AREPS..27....1A", ["Smith 1990 (doi:10.1/b)"])]),
    ("/s/X/0/x.xref.xml", "CrossRef", f"<ADSBIBCODE>{BIB}</ADSBIBCODE><citation_list><citation key='1'><unstructured_citation>Smith 1990, ApJ</unstructured_citation></citation><citation key='2' /></citation_list>", [(BIB, ["Smith 1990, ApJ"])]),
    ("/s/X/0/lrr-1.living.xml", "LivingReviews", "<record><author>A</author><year>1999</year><title>T</title></record>", [("1998LRR.....1....3R", ["A, 1999. T."])]),
    ("/s/X/0/m.xml", "MDPI", f"<ADSBIBCODE>{BIB}</ADSBIBCODE><ref><person-group person-group-type='author'><name><surname>Ab</surname></name></person-group><year>2001</year><source>J</source><volume>1</volume></ref><ref>---<year>2002</year><source>J</source><volume>2</volume></ref>", [(BIB, ["Ab, 2001. J, 1.", "Ab, 2002. J, 2."])]),
    ("/s/X/0/short.raw", "arXiv", "%R short\n%Z\nSmith 1990\n", []),
    ("/s/X/0/empty.raw", "arXiv", "", []),
    ("/s/X/0/u.raw", "Unknown", "x", []),
]


def test_files(spark):
    df = spark.createDataFrame([(p, bytearray(t.encode()), n) for p, n, t, _ in FILES], "path string, content binary, parser_name string")
    rows = parse_files(df, {"10.1146/a": "1999AREPS..27....1A", "lrr-1": "1998LRR.....1....3R"}).collect()
    for path, _, _, want in FILES:
        mine = [r for r in rows if r.source_filename == path]
        got = {}
        for r in sorted((r for r in mine if r.error is None), key=lambda r: r.pos):
            got.setdefault(r.source_bibcode, []).append(r.refstr or r.refplaintext.replace(" --- Incomplete", ""))
        assert sorted(got.items()) == sorted(want), path
        assert want or [r.error for r in mine][0]


def test_buffers(spark):
    ref = "array<struct<source_bibcode:string,references:array<struct<item_num:int,refstr:string,refraw:string>>>>"
    rows = [("f.raw", "arXiv", [(BIB, [(4, "x", "[1] Smith 1990"), (9, "Doe 1991", None)])]), ("f.xml", "CrossRef", [(BIB, [(1, None, "<citation><unstructured_citation>Roe 1992, ApJ</unstructured_citation></citation>"), (2, None, "")])])]
    got = parse_blocks(spark.createDataFrame(rows, f"source_filename string, parser_name string, block_references {ref}")).collect()
    assert sorted((r.source_filename, r.item_num, r.refstr or r.refplaintext, r.error is None) for r in got if r.error is None) == [("f.raw", 4, "Smith 1990", True), ("f.raw", 9, "Doe 1991", True), ("f.xml", 1, "Roe 1992, ApJ", True)]
    assert [r.item_num for r in got if r.error] == [2]


def test_rows_of_small_files_share_batches():
    from refloom.parse import frames

    row = ("p", None, None, None, "raw", *[None] * (len(frames.ARROW) - 6), "none")
    made = [b.num_rows for b in frames._batched(iter([([row] * n, 9) for n in [1] * 1500 + [0, 2500]]), frames.ARROW)]
    assert sum(made) == 4000 and max(made) <= frames.ROWS and len(made) <= 5
    assert len(list(frames._batched(iter([([row], frames.BYTES)] * 3), frames.ARROW))) == 3
    assert not list(frames._batched(iter([]), frames.ARROW))


def test_files_of_one_small_table_are_parsed_by_all_cores(spark):
    from refloom.plans import parsing

    one = spark.range(40).select(F.col("id").alias("s_suppkey")).coalesce(1)
    tasks = parsing._files(one, {"arXiv": "{t}"}).select(F.spark_partition_id().alias("t"), "path").collect()
    assert len({r.t for r in tasks}) >= min(4, spark.sparkContext.defaultParallelism) and len({r.path for r in tasks}) == 40


def test_living_reviews_are_parsed_by_all_cores(spark, tmp_path):
    from refloom.plans import registry

    spark.range(40).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    got = registry.queries()["xml_dialects"](spark, str(tmp_path)).select("parser_name", "s_suppkey", F.spark_partition_id().alias("t")).where("parser_name = 'LivingReviews'").collect()
    assert len({r.s_suppkey for r in got}) == len(got) == 40 and len({r.t for r in got}) >= min(4, spark.sparkContext.defaultParallelism)


def test_pages_of_five_digits_keep_their_references(spark):
    page = '<p class="author">by <strong>A Zed</strong> Issue 1, Volume 7:%d-999, 1980<p class="reference">Doe, X. 1980, Icarus, 1, 2</p>'
    files = spark.createDataFrame([(f"f{k}", "AEdRvHTML", bytearray((page % k).encode())) for k in (9999, 10000)], "path string, parser_name string, content binary")
    assert sorted((r.source_bibcode, r.error) for r in parse_files(files).collect()) == [("1980AEdRv...710000Z", None), ("1980AEdRv...7a9999Z", None)]
