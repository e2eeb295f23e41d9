"""Markup extraction on the pages table, through the functions that the result pages use."""

from pyspark.sql import functions as F

from ringledger.checks.registry import check, table
from ringledger.functions import html
from ringledger.operators.extract import numbered, picture_flag, row_flags, spread

_BODY = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g')"
_LI = r"(?is)<li(?:\s[^>]*)?>.*?</li\s*>"
_P = r"(?is)<p(?:\s[^>]*)?>.*?</p\s*>"
_WORDS = r"regexp_replace({}, '<[/!a-zA-Z][^>]*>', '', 'g')"


def _sql_text(fragment: str) -> str:
    plain = _WORDS.format(fragment)
    for name, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        plain = f"regexp_replace({plain}, '&{name};?', '{char}', 'g')"
    return rf"regexp_replace({plain}, '^\s+|\s+$', '', 'g')"


def _fetched(spark, d):
    return spread(table(spark, d, "pages"), "page_id")


def _pages(spark, d):
    return _fetched(spark, d).select("page_id", "url", html.markup(F.col("html")).alias("html"))


@check(
    rf"""SELECT page_id, (n - i + 1)::INT AS position, {_sql_text("rows[i]")} AS name FROM
    (SELECT page_id, rows, len(rows) AS n, unnest(range(2, len(rows) + 1)) AS i FROM
      (SELECT page_id, regexp_extract_all({_BODY}, '{_LI}') AS rows FROM pages))"""
)
def html_index_rows(spark, d):
    """Rows after the first, numbered from the last one up."""
    rows = html.elements(F.col("html"), "li")
    out = numbered(_pages(spark, d).select("page_id", "html"), rows, "row", "position", skip=1, oldest_first=True)
    return out.select("page_id", "position", html.text(F.col("row")).alias("name"))


@check(
    rf"""SELECT page_id, generate_subscripts(items, 1)::INT AS item, {_sql_text("unnest(items)")} AS text FROM
    (SELECT page_id, regexp_extract_all({_BODY}, '{_LI}') AS items FROM pages)"""
)
def html_open_items(spark, d):
    """The items of pages that lack the closing tags of all items and links."""
    page = F.regexp_replace("html", r"</(?:li|a)\s*>", "")
    items = numbered(_pages(spark, d).select("page_id", page.alias("html")), html.elements(F.col("html"), "li"), "li", "item")
    return items.select("page_id", "item", html.text(F.col("li")).alias("text"))


# where a paragraph ends that is not closed: at the next block, or at the end of what it stands in
_BLOCK = "(?:p|h[1-6]|div|ul|ol|nav|article|header|footer|main|section|table|pre|blockquote|hr)"
_P_END = rf"(?is)\A(.*?)(?:</?{_BLOCK}(?:\s[^>]*)?>|</(?:li|td|body|html)>|\z)"


@check(
    rf"""SELECT page_id, (pos - 1)::INT AS position, {_sql_text(f"regexp_extract(part, '{_P_END}', 1)")} AS text FROM
    (SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM
      (SELECT page_id, string_split_regex({_BODY}, '(?i)<p(?:\s[^>]*)?>') AS parts FROM pages)) WHERE pos > 1"""
)
def html_open_paragraphs(spark, d):
    """Paragraphs as HTML reads them, many without a closing tag in the pages."""
    paragraphs = html.elements(F.col("html"), "p")
    out = numbered(_pages(spark, d).select("page_id", "html"), paragraphs, "p", "position")
    return out.select("page_id", "position", html.text(F.col("p")).alias("text"))


@check(
    rf"""SELECT page_id, pos::INT AS position, {_sql_text("item")} AS name,
    regexp_extract(item, '(?is)<a\b[^>]*\shref="([^"]*)"', 1) AS link FROM
    (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM
      (SELECT page_id, regexp_extract_all({_BODY}, '(?is)<a(?:\s[^>]*)?>.*?</a\s*>') AS items FROM pages))
    WHERE item LIKE '%href=%'"""
)
def html_link_pairs(spark, d):
    anchors = numbered(_pages(spark, d).select("page_id", "html"), html.elements(F.col("html"), "a"), "a", "position")
    link = html.attribute(F.col("a"), "href").alias("link")
    return anchors.select("page_id", "position", html.text(F.col("a")).alias("name"), link).filter("link IS NOT NULL")


@check(
    rf"""SELECT page_id, n::INT AS paragraphs, {_sql_text("cells[1]")} AS opening FROM (SELECT page_id,
    regexp_extract_all({_BODY}, '{_P}') AS cells, len(cells) AS n FROM pages) WHERE n >= 4"""
)
def html_row_filter_by_arity(spark, d):
    cells = _pages(spark, d).select("page_id", html.elements(F.col("html"), "p", implied=False).alias("cells"))
    kept = cells.filter(F.size("cells") >= 4)
    return kept.select("page_id", F.size("cells").alias("paragraphs"), html.text(F.col("cells")[0]).alias("opening"))


@check(
    rf"""SELECT page_id, {_sql_text("b[1]")} AS first, {_sql_text("b[2]")} AS second, {_sql_text("b[3]")} AS third,
    {_sql_text("b[4]")} AS fourth FROM (SELECT page_id, regexp_extract_all({_BODY}, '{_P}') AS b FROM pages)"""
)
def html_kth_section(spark, d):
    b = _pages(spark, d).select("page_id", html.elements(F.col("html"), "p", implied=False).alias("b"))
    names = ["first", "second", "third", "fourth"]
    return b.select("page_id", *[html.text(F.get("b", F.lit(k))).alias(n) for k, n in enumerate(names)])


@check(
    rf"""SELECT page_id, unnest(links) AS link, unnest(names) AS name FROM (SELECT page_id,
    list_transform(items, lambda x: regexp_extract(x, '(?is)<a\b[^>]*\shref="([^"]*)"', 1)) AS links,
    list_transform(items, lambda x: {_sql_text("x")}) AS names FROM
      (SELECT page_id, regexp_extract_all({_BODY}, '{_LI}') AS items FROM pages))"""
)
def html_transpose(spark, d):
    """A column of links and a column of names, one line per item, turned into rows."""
    items = html.elements(F.col("html"), "li")
    columns = _pages(spark, d).select(
        "page_id",
        F.transform(items, lambda x: html.attribute(html.first(x, "a"), "href")).alias("link"),
        F.transform(items, html.tight_text).alias("name"),
    )
    return columns.select("page_id", F.inline(F.arrays_zip("link", "name")))


@check(
    rf"""SELECT page_id, section, (row_number() OVER (PARTITION BY page_id, section ORDER BY pos))::INT AS item,
    {_sql_text("part")} AS text FROM (
      SELECT page_id, 'nav' AS section, unnest(x) AS part, generate_subscripts(x, 1) AS pos FROM (SELECT page_id,
        regexp_extract_all(regexp_extract({_BODY}, '(?is)<nav(?:\s[^>]*)?>.*?</nav\s*>'), '{_LI}') AS x FROM pages)
      UNION ALL SELECT page_id, 'article', unnest(x), generate_subscripts(x, 1) FROM (SELECT page_id,
        regexp_extract_all(regexp_extract({_BODY}, '(?is)<article(?:\s[^>]*)?>.*?</article\s*>'), '{_P}') AS x FROM pages))"""
)
def html_two_level_explode(spark, d):
    """Page to labelled section to item."""
    page = F.col("html")
    sections = F.array(
        *[
            F.struct(F.lit(tag).alias("section"), html.elements(html.first(page, tag), item, implied=item != "p").alias("items"))
            for tag, item in (("nav", "li"), ("article", "p"))
        ]
    )
    per_section = _pages(spark, d).select("page_id", F.inline(sections))
    items = numbered(per_section, F.col("items"), "part", "item").drop("items")
    return items.select("page_id", "section", "item", html.text(F.col("part")).alias("text"))


@check(
    rf"""SELECT page_id, {_sql_text("regexp_extract(html, '(?is)<title>.*?</title>')")} AS title,
    {_sql_text("regexp_extract(" + _BODY + ", '(?is)<footer>.*?</footer>')")} AS footer FROM pages"""
)
def html_title_text(spark, d):
    p = _pages(spark, d)
    return p.select(
        "page_id",
        html.text(html.first(F.col("html"), "title")).alias("title"),
        F.coalesce(html.text(html.first(F.col("html"), "footer")), F.lit("")).alias("footer"),
    )


@check(
    f"""SELECT page_id, contains({_BODY}, 'class="ad"')::INT AS ad, contains({_BODY}, '&quot;')::INT AS quoted,
    contains({_BODY}, '<br>')::INT AS broken, contains({_BODY}, 'track(')::INT AS scripted,
    CASE WHEN contains({_BODY}, '<img') THEN 'Yes' ELSE '' END AS picture FROM pages"""
)
def html_marker_flags(spark, d):
    marks = [("ad", 'class="ad"'), ("quoted", "&quot;"), ("broken", "<br>"), ("scripted", "track(")]
    page = F.col("html")
    return _pages(spark, d).select("page_id", *row_flags(page, marks), picture_flag(page).alias("picture"))


@check(
    rf"""SELECT page_id, url, CASE WHEN len(b) < 5 THEN 'too few paragraphs' ELSE 'no closing of the page' END AS reason
    FROM (SELECT page_id, url, html, regexp_extract_all({_BODY}, '{_P}') AS b FROM pages)
    WHERE len(b) < 5 OR NOT ends_with(html, '</html>')"""
)
def html_rejects(spark, d):
    """Pages that cannot be read, with the reason; the others go on."""
    b = _fetched(spark, d).select(
        "page_id",
        "url",
        F.col("html").endswith("</html>").alias("closed"),
        F.size(html.elements(html.markup(F.col("html")), "p", implied=False)).alias("n"),
    )
    reason = F.when(F.col("n") < 5, "too few paragraphs").when(~F.col("closed"), "no closing of the page")
    return b.select("page_id", "url", reason.alias("reason")).filter("reason IS NOT NULL")
