import pytest
from pyspark.sql import functions as F

from ringledger.functions import html
from ringledger.operators import extract
from ringledger.schemas import STRIKES, TOTALS
from tests import site
from tests.conftest import rows


def page_frame(spark, *pages):
    return spark.createDataFrame([(p,) for p in pages], "html string")


@pytest.mark.parametrize(
    "given, end_trimmed, tight",
    [
        ("<p> a <b> b </b> c </p>", "a  b  c", "abc"),
        ("<p>\n Tom &amp; Jerry </p>", "Tom & Jerry", "Tom & Jerry"),
        ("<p>&nbsp;x&nbsp;y&nbsp;</p>", "x y", "x y"),
        ("<p>&#233;&#xE9;&eacute;&#8364;</p>", "ééé€", "ééé€"),
        ("<p>&amp;lt;b&amp;gt; &lt;i&gt;</p>", "&lt;b&gt; <i>", "&lt;b&gt; <i>"),
        ("<p>&amp;#38;lt; &unknown; a & b &</p>", "&#38;lt; &unknown; a & b &", "&#38;lt; &unknown; a & b &"),
        ("<p>&copy 2025 &rsquo;&ndash;&#150; R&R, AT&T</p>", "© 2025 ’–– R&R, AT&T", "© 2025 ’–– R&R, AT&T"),
        ("<p>&#0;&#xD800;&#9999999;&#39;&#x27</p>", "\ufffd\ufffd\ufffd''", "\ufffd\ufffd\ufffd''"),
        ("<title>cut off &amp;&amp</title>", "cut off &&", "cut off &&"),
        ('<p title="a > b">x</p>', "x", "x"),
        ("<p>3 < 4</p>", "3 < 4", "3 < 4"),
        ("<p></p>", "", ""),
        ("<p>&lowbar;&check;&#0000000065;&#x000041;&notit;&#65b</p>", "_✓AA¬it;Ab", "_✓AA¬it;Ab"),
    ],
)
def test_text(spark, given, end_trimmed, tight):
    got = page_frame(spark, given).select(html.text(F.col("html")), html.tight_text(F.col("html"))).first()
    assert tuple(got) == (end_trimmed, tight)


def test_elements_by_class(spark):
    page = (
        '<!-- <td class="c">no</td> --><script>"<td class=c>no</td>"</script>'
        "<td>0</td><td class='c'>1</td><TD id=\"x\" class=\"b c\">2</TD><td class=\"cc\">3</td>"
        '<td data-class="c">4</td><td class="c d">5</td><tdx class="c">6</tdx>'
    )
    found = html.elements(html.markup(F.col("html")), "td", "c")
    whole = html.elements(html.markup(F.col("html")), "td", "c d")
    got = page_frame(spark, page).select(F.transform(found, html.text), F.transform(whole, html.text)).first()
    assert tuple(got) == (["1", "2", "5"], ["5"])


@pytest.mark.parametrize(
    "tag, expected",
    [
        ('<a class="x" href="/y?a=1&amp;b=2">t</a>', "/y?a=1&b=2"),
        ('<a href="/y?a=1&lt=2&copy=3">t</a>', "/y?a=1&lt=2&copy=3"),
        ("<a href='/y'>t</a>", "/y"),
        ("<a href=/y>t</a>", "/y"),
        ('<a href="">t</a>', ""),
        ('<a data-href="/n">t</a>', None),
        ('<a><b href="/n"></b></a>', None),
    ],
)
def test_attribute(spark, tag, expected):
    assert page_frame(spark, tag).select(html.attribute(F.col("html"), "href")).first()[0] == expected


def test_long_tag_and_long_page(spark):
    page = "<p " + " ".join(f'a{i}="{i} > {i}"' for i in range(300)) + ">x</p>" + "<p>y</p>" * 20_000 + "z" * 500_000
    got = page_frame(spark, page).select(F.size(html.elements(F.col("html"), "p", None))).first()[0]
    assert got == 20_001


EVENTS = [
    ("Night 3, again", "May 17, 2025", "Las Vegas, USA", "http://site.test/e3"),
    ("Night 2 &amp; more", "May 10, 2025", "Montreal", "http://site.test/e2"),
    ("Unlinked", "May 9, 2025", "Here", None),
    ("Undated", None, "There", "http://site.test/e0"),
    ("Night 1", "March 11, 1994", "---", "http://site.test/e1"),
]


def test_index(spark):
    pages = page_frame(spark, site.index_page(EVENTS))
    assert rows(extract.index_events(pages).select("position", "event_name", "date", "location", "link", "readable")) == [
        (1, "Night 1", "March 11, 1994", "---", "http://site.test/e1", True),
        (2, "Undated", None, "There", "http://site.test/e0", False),
        (3, None, "May 9, 2025", "Here", None, True),
        (4, "Night 2 & more", "May 10, 2025", "Montreal", "http://site.test/e2", True),
        (5, "Night 3, again", "May 17, 2025", "Las Vegas, USA", "http://site.test/e3", True),
    ]
    assert rows(extract.index_links(pages).select("position", "event_name")) == [
        (1, "Night 1"),
        (2, "Undated"),
        (4, "Night 2 & more"),
        (5, "Night 3, again"),
    ]


def test_directory(spark):
    good = ("Ann", "O'Neil", "The &quot;Ace&quot;", "6' 3\"", "205 lbs.", '75.0"', "Orthodox", "21", "1", "0", True, "http://f/1")
    bare = ("Bo", "--", "", "--", "--", "--", "", "0", "0", "0", False, "http://f/2")
    short = '<tr class="b-statistics__table-row"><td class="b-statistics__table-col">only one</td></tr>'
    pages = page_frame(spark, site.directory_page([short, good, bare]), "<html><p>no table</p></html>")
    assert rows(extract.directory_fighters(pages)) == [
        ("Ann", "O'Neil", 'The "Ace"', "6' 3", "205 lbs.", "75.0", "Orthodox", "21", "1", "0", "Yes", "http://f/1"),
        ("Bo", "--", "", "--", "--", None, "", "0", "0", "0", "", "http://f/2"),
    ]


def test_cells_of_the_directory_are_found_once(spark):
    """The filter on the number of cells does not compute them a second time."""
    df = extract.directory_fighters(page_frame(spark, ""))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("(?i)<td(?=") == 1


FIGHTS = [
    ("win", "Ann A", "Bea B", "Lightweight", "KO/TKO", "Punches", "1", "3:39", ["belt.png", "perf.png"], "http://d/1"),
    ("nc", "Cid C", "Dan D", "Open Weight", "U-DEC", "", "3", "5:00", ["fight.png"], "http://d/2"),
    ("win", "Eve E", "Fay F", "---", "SUB", "---", "2", "0:30", ["sub.png", "ko.png"], None),
]


def test_card(spark):
    broken = site.event_page(FIGHTS[:1]).replace('<i class="b-flag__text">win</i>', "")
    pages = spark.createDataFrame(
        [("N1", 1, site.event_page(FIGHTS)), ("N2", 2, broken)], "event_name string, event_position int, html string"
    )
    got = rows(extract.card_fights(pages))
    assert got == [
        ("N1", 1, "Ann A", "Ann A", "Bea B", "Lightweight", "KO/TKO", "Punches", "1", "3:39", 1, 0, 1, 0, 0, "http://d/1", 1, True),
        ("N1", 2, "nc", "Cid C", "Dan D", "Open Weight", "U-DEC", "", "3", "5:00", 0, 1, 0, 0, 0, "http://d/2", 1, True),
        ("N1", 3, "Eve E", "Eve E", "Fay F", "---", "SUB", "---", "2", "0:30", 0, 0, 0, 1, 1, None, 1, True),
        ("N2", 1, "nc", "Ann A", "Bea B", "Lightweight", "KO/TKO", "Punches", "1", "3:39", 1, 0, 1, 0, 0, "http://d/1", 2, False),
    ]
    assert rows(extract.card_links(pages)) == [
        ("N1", 1, 1, "http://d/1"),
        ("N1", 1, 2, "http://d/2"),
        ("N1", 1, 3, None),
        ("N2", 2, 1, "http://d/1"),
    ]


def stats(tag, n):
    return [(f, *[f"{tag}{f}{i}" for i in range(n)]) for f in ("Ann A", "Bea B")]


def good_page():
    totals = [(f"Round {r}", stats(f"t{r}", 9)) for r in (1, 2)]
    strikes = [(f"Round {r}", stats(f"s{r}", 6)) for r in (1, 2)]
    return site.fight_page(stats("t", 9), stats("s", 6), totals, strikes)


def test_fight_sections(spark):
    cut = good_page().replace('<tbody class="b-fight-details__table-body">', "<tbody>", 1)
    lacking = good_page().replace("tBea B8", "").replace("<p class='b-text'>\n \n </p>", "")
    no_row = good_page().replace("Round 2 </th></tr></thead><tr", "Round 2 </th></tr></thead><div", 1)
    data = [("N", 1, good_page()), ("N", 2, cut), ("N", 3, lacking), ("N", 4, None), ("N", 5, no_row)]
    sections = extract.fight_sections(spark.createDataFrame(data, "event string, fight_id int, html string"))
    assert rows(sections.select("fight_id", "readable")) == [(1, True), (2, False), (3, False), (4, False), (5, False)]
    good = sections.filter("readable")
    keys = ["event", "fight_id"]
    assert rows(extract.section_rows(good, "totals", TOTALS, keys, False)) == [("N", 1, *r) for r in stats("t", 9)]
    assert rows(extract.section_rows(good, "strikes", STRIKES, keys, False)) == [("N", 1, *r) for r in stats("s", 6)]
    assert rows(extract.section_rows(good, "round_totals", TOTALS, keys, True)) == [
        ("N", 1, f"Round {n}", *r) for n in (1, 2) for r in stats(f"t{n}", 9)
    ]
    assert rows(extract.section_rows(good, "round_strikes", STRIKES, keys, True)) == [
        ("N", 1, f"Round {n}", *r) for n in (1, 2) for r in stats(f"s{n}", 6)
    ]


def test_round_headings_are_written_with_a_capital(spark):
    page = good_page().replace("Round 2 </th>", "around it </th>")
    loud = good_page().replace("Round 2 </th>", "ROUND 2 </th>")
    pages = spark.createDataFrame([("N", 1, page), ("N", 2, loud)], "event string, fight_id int, html string")
    got = extract.section_rows(extract.fight_sections(pages), "round_totals", TOTALS, ["fight_id"], True)
    assert rows(got.select("fight_id", "round").distinct()) == [(1, "Round 1"), (2, "Round 1")]


def test_cells_in_passes_and_line_by_line_agree(spark):
    cells = [
        "<td class='c'><p>\n one <b> two </b>three</p><p>4</p></td>",
        '<td class="b c" title="a > b"><p class="x">a\xa0b</p>lost<P>\u2003B </P></td>',
        "<td class='d'><p>not this</p></td><td class='c'>bare</td>",
        "<td class='c'><p>open<p>next</p></p></td>",
        "<td class='c'><pre>x</pre><p></p><p>3 < 4</p></td>",
    ]
    plain = "<tr>" + "".join(cells) + "</tr>"
    # a reference outside the cells makes the row be read line by line
    df = spark.createDataFrame([(plain,), (plain.replace("<tr>", "<tr>&amp;"),)], "html string")
    fast, slow = [r[0] for r in df.select(html.stacked_cells(F.col("html"), "c")).collect()]
    assert fast == slow == [["onetwothree", "4"], ["a\xa0b", "B"], [], ["open", "next"], ["", "3 < 4"]]


def test_a_row_of_cells_is_read_in_few_passes(spark):
    df = spark.createDataFrame([("",)], "html string").select(html.stacked_cells(F.col("html"), "c"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") <= 6  # with those of a line that is read by itself


def test_cells_in_any_case_and_between_other_cells(spark):
    cases = {
        '<TR><Td CLASS="C"><P>\u2003Ann\u2003<P>Bea</P>x</tD><TH>no</TH><td class=\'c\'>\n<p><a href="/x"> 1 <i> 2 </i></a> </p>': [
            ["Ann", "Bea"],
            ["12"],
        ],
        '<tr><td class="c"><p> </p><p>a < b</p><td class="d"><p>no</p><td class="c">': [["", "a < b"], []],
    }
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    got = df.select("html", html.stacked_cells(F.col("html"), "c")).collect()
    assert dict(map(tuple, got)) == cases


def test_sections_are_computed_once_below_a_filter(spark):
    pages = spark.createDataFrame([("N", 1, "")], "event string, fight_id int, html string")
    sections = extract.fight_sections(pages)

    def patterns(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(")

    assert 0 < patterns(sections.filter("readable")) <= patterns(sections)


def test_no_python_worker_in_extraction(spark):
    pages = spark.createDataFrame([("N", 1, "")], "event string, fight_id int, html string")
    plan = extract.fight_sections(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
