"""Result pages that Spark writes from the tables and reads back through the extraction jobs.

Pages hold a bounded range of keys each, so their size does not depend on how rows are spread over keys.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.checks.registry import check, table
from ringledger.operators import extract
from ringledger.operators.joins import left_join
from ringledger.schemas import STRIKES, TOTALS
from ringledger.session import shared_folder
from ringledger.sources import files
from ringledger.values import CARD_BODY, CARD_CELL, CARD_ROW, LIST_CELL, LIST_DATE, LIST_LINK, LIST_PLACE, LIST_ROW


def filled_in(template: str, **parts: Column) -> Column:
    """Template with `{name}` replaced by columns."""
    pieces = []
    for chunk in template.split("{"):
        name, closed, rest = chunk.partition("}")
        if closed:
            pieces.append(parts[name].cast("string"))
        pieces.append(F.lit(rest if closed else name))
    return F.concat(*pieces)


def pages_of(rows: DataFrame, size: int, head: str) -> DataFrame:
    """Pages of `size` consecutive numbers; `rows` has number and row. Rows stand in falling order of the number."""
    body = F.expr("listagg(row, '') WITHIN GROUP (ORDER BY number DESC)")
    page = F.floor(F.col("number") / size).alias("page")
    whole = F.concat(F.lit(f"<html><table><tbody>{head}"), "body", F.lit("</tbody></table></html>"))
    return rows.groupBy(page).agg(body.alias("body")).select("page", whole.alias("html"))


@check(
    """SELECT 'Night ' || o_orderkey AS event_name, strftime(o_orderdate, '%B %-d, %Y') AS date,
    'Hall & ' || o_orderpriority AS location, 'http://site.test/' || o_orderkey AS link,
    (row_number() OVER (PARTITION BY o_orderkey // 50 ORDER BY o_orderkey))::INT AS position, true AS readable
    FROM orders"""
)
def extract_index(spark, d):
    """Event list pages, newest first."""
    key = F.col("o_orderkey")
    row = filled_in(
        f'<tr class="{LIST_ROW}"><td class="{LIST_CELL}"><a href="http://site.test/{{k}}" class="{LIST_LINK}">\n Night {{k}} '
        f'</a><span class="{LIST_DATE}"> {{date}}\n</span></td><td class="{LIST_PLACE}">\n Hall &amp; {{place}}</td></tr>',
        k=key,
        date=F.date_format("o_orderdate", "MMMM d, yyyy"),
        place=F.col("o_orderpriority"),
    )
    rows = table(spark, d, "orders").select(key.alias("number"), row.alias("row"))
    return extract.index_events(pages_of(rows, 50, f'<tr class="{LIST_ROW}"><td></td></tr>'))


@check(
    """SELECT 'Night ' || o_orderkey AS event_name, 'http://site.test/' || o_orderkey AS link,
    (row_number() OVER (PARTITION BY o_orderkey // 50 ORDER BY o_orderkey))::INT AS position
    FROM orders QUALIFY o_orderstatus <> 'P'"""
)
def extract_links(spark, d):
    """Linked rows of the event list; rows without a link keep their place but are left out."""
    key = F.col("o_orderkey")
    linked = filled_in(f'<tr class="{LIST_ROW}"><td><a href="http://site.test/{{k}}">Night {{k}}</a></td></tr>', k=key)
    bare = F.lit(f'<tr class="{LIST_ROW}"><td>no link</td></tr>')
    row = F.when(F.col("o_orderstatus") == "P", bare).otherwise(linked)
    rows = table(spark, d, "orders").select(key.alias("number"), row.alias("row"))
    return extract.index_links(pages_of(rows, 50, f'<tr class="{LIST_ROW}"><td></td></tr>'))


@check(
    """SELECT c_mktsegment AS first_name, c_name AS last_name, CASE WHEN c_custkey % 2 = 0 THEN 'Mc "X"' ELSE '' END AS nickname,
    '6'' ' || c_custkey % 12 AS height, c_custkey % 300 || ' lbs.' AS weight,
    CASE WHEN c_custkey % 4 > 0 THEN '7' || c_custkey % 10 || '.0' END AS reach, 'Orthodox' AS stance,
    (c_custkey % 30)::VARCHAR AS wins, (c_custkey % 20)::VARCHAR AS losses, (c_custkey % 3)::VARCHAR AS draws,
    CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE '' END AS belt, 'http://site.test/f' || c_custkey AS link
    FROM customer WHERE c_mktsegment <> 'MACHINERY'"""
)
def extract_directory(spark, d):
    """Fighter directory pages; rows with too few cells are left out."""
    return extract.directory_fighters(directory_pages(spark, d))


def directory_pages(spark, d) -> DataFrame:
    """A hundred customers to a page, those of one segment without cells."""
    key = F.col("c_custkey")
    texts = [
        filled_in('<a href="http://site.test/f{k}">{s}</a>', k=key, s=F.col("c_mktsegment")),
        F.col("c_name"),
        F.when(key % 2 == 0, "Mc &quot;X&quot;").otherwise(""),
        filled_in("6' {i}\"", i=key % 12),
        filled_in("{w} lbs.", w=key % 300),
        F.when(key % 4 == 0, "--").otherwise(filled_in('7{r}.0"', r=key % 10)),
        F.lit("Orthodox"),
        key % 30,
        key % 20,
        key % 3,
        F.when(F.col("c_acctbal") > 5000, '<img src="belt.png">').otherwise(""),
    ]
    cells = F.concat(*[filled_in(f'<td class="{LIST_CELL}">\n {{t}} </td>', t=t) for t in texts])
    short = F.lit(f'<td class="{LIST_CELL}">retired</td>')
    row = filled_in(f'<tr class="{LIST_ROW}">{{c}}</tr>', c=F.when(F.col("c_mktsegment") == "MACHINERY", short).otherwise(cells))
    rows = table(spark, d, "customer").select(key.alias("number"), row.alias("row"))
    return pages_of(rows, 100, "")


@check(
    """SELECT 'Card ' || o_orderkey // 20 AS event_name, (row_number() OVER (PARTITION BY o_orderkey // 20
      ORDER BY o_orderkey DESC))::INT AS fight_id, CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
      THEN 'Red ' || o_custkey ELSE 'nc' END AS fight_result, 'Red ' || o_custkey AS fighter_1, 'Blue ' || o_orderkey AS fighter_2, substr(o_orderpriority, 3)
      AS weight_class, 'KO/TKO' AS method, CASE WHEN o_orderkey % 2 = 0 THEN 'Punches' ELSE '' END AS description,
    (o_orderkey % 5 + 1)::VARCHAR AS round, '4:' || (10 + o_orderkey % 50) AS time,
    (o_orderkey % 3 = 0)::INT AS championship_fight, 0 AS fight_of_the_night, (o_totalprice > 300000)::INT
      AS performance_of_the_night, 0 AS sub_of_the_night, 0 AS ko_of_the_night,
    CASE WHEN o_orderkey % 4 > 0 THEN 'http://site.test/d' || o_orderkey END AS fight_stats_link,
    (o_orderkey // 20)::INT AS event_position, o_orderpriority <> '5-LOW' AS readable FROM orders"""
)
def extract_card(spark, d):
    """Event pages of fights; a row without the result flag is not readable."""
    key = F.col("o_orderkey")
    flag = F.when(F.col("o_orderstatus") == "F", "win").otherwise("draw")
    link = F.when(key % 4 > 0, filled_in(' data-link="http://site.test/d{k}"', k=key)).otherwise("")
    icons = F.concat(
        F.when(key % 3 == 0, '<img src="belt.png">').otherwise(""),
        F.when(F.col("o_totalprice") > 300000, '<img src="perf.png">').otherwise(""),
    )
    row = filled_in(
        f'<tr class="{CARD_ROW} js"{{link}}><td>{{flag}}</td><td><p><a class="b-link" href="#"> Red {{c}} </a></p>'
        '<p><a class="b-link" href="#">\nBlue {k}</a></p></td><td></td><td></td><td></td><td></td><td><p> {w} {icons}</p></td>'
        "<td><p>KO/TKO</p><p> {how} </p></td><td><p>{r}</p></td><td><p>\n4:{s}</p></td></tr>",
        link=link,
        flag=F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(filled_in('<i class="b-flag"><i class="b-flag__text">{f}</i></i>', f=flag)),
        c=F.col("o_custkey"),
        k=key,
        w=F.expr("substr(o_orderpriority, 3)"),
        icons=icons,
        how=F.when(key % 2 == 0, "Punches").otherwise(""),
        r=key % 5 + 1,
        s=key % 50 + 10,
    )
    rows = table(spark, d, "orders").select(key.alias("number"), row.alias("row"))
    pages = pages_of(rows, 20, f'<tr class="{CARD_ROW}"><th>W/L</th></tr>')
    named = pages.select(
        F.concat(F.lit("Card "), "page").alias("event_name"), F.col("page").cast("int").alias("event_position"), "html"
    )
    return extract.card_fights(named)


def fight_pages(spark, d) -> DataFrame:
    """A fight page per customer, with one to three rounds and two fighters."""
    c = F.col("c_custkey")
    cell = f'<td class="{CARD_CELL}">{{a}}</td>'

    def row(first: list[Column], second: list[Column]) -> Column:
        stacked = [filled_in(cell, a=filled_in("<p>\n {x} </p><p>{y}</p>", x=x, y=y)) for x, y in zip(first, second)]
        return filled_in(f'<tr class="{CARD_ROW}">{{c}}</tr>', c=F.concat(*stacked))

    def line(corner: str, n: int, mark: Column) -> list[Column]:
        return [filled_in(f"{corner} {{c}}", c=c), *[filled_in(f"{{m}}{i} of {{c}}", m=mark, c=c) for i in range(n)]]

    def section(n: int) -> Column:
        return row(line("Red", n, F.lit("")), line("Blue", n, F.lit("-")))

    def rounds(n: int) -> Column:
        def one(r: Column) -> Column:
            head = filled_in('<thead><tr><th colspan="10">\n Round {r} </th></tr></thead>', r=r)
            return F.concat(head, row(line("Red", n, r), line("Blue", n, F.negative(r))))

        return F.array_join(F.transform(F.sequence(F.lit(1), (c % 3 + 1).cast("int")), one), "")

    # two columns that the strike sections do not use stand before the six that they do
    bodies = [section(len(TOTALS)), rounds(len(TOTALS)), section(len(STRIKES) + 2), rounds(len(STRIKES) + 2)]
    tables = [filled_in(f'<table><tbody class="{CARD_BODY}">{{b}}</tbody></table>', b=b) for b in bodies]
    kept = tables[:3] + [F.when(F.col("c_acctbal") > 0, tables[3]).otherwise("")]
    page = F.concat(F.lit("<html>"), *kept, F.lit("</html>"))
    customers = extract.spread(table(spark, d, "customer"), "c_custkey")
    return customers.select(c.cast("string").alias("event"), F.lit(1).alias("fight_id"), page.alias("html"))


def _sections(spark, d) -> DataFrame:
    """Sections of the readable pages, stored as the weekly load does, since several tables are read from them."""
    path = shared_folder(spark)
    files.overwrite(extract.fight_sections(fight_pages(spark, d)), path)
    return spark.read.parquet(path).filter("readable")


def _values(names: list[str], skip: int, mark: str) -> str:
    return ", ".join(f"{mark} || '{i + skip} of ' || c_custkey AS {n}" for i, n in enumerate(names))


_STAT_SQL = """SELECT c_custkey::VARCHAR AS event, 1 AS fight_id, corner || ' ' || c_custkey AS fighter, {totals}, {strikes}
    FROM customer, (VALUES ('Red', ''), ('Blue', '-')) v(corner, m) WHERE c_acctbal > 0"""


@check(_STAT_SQL.format(totals=_values(TOTALS, 0, "m"), strikes=_values(STRIKES, 2, "m")))
def extract_fight_stats(spark, d):
    """Totals joined with strikes, one row per fighter. Pages with three sections only are not readable."""
    good = _sections(spark, d)
    keys = ["event", "fight_id"]
    totals = extract.section_rows(good, "totals", TOTALS, keys, by_round=False)
    strikes = extract.section_rows(good, "strikes", STRIKES, keys, by_round=False)
    return left_join(totals, strikes, [*keys, "fighter"])


@check(_STAT_SQL.format(totals=_values(TOTALS, 0, "m"), strikes=_values(STRIKES, 2, "m")))
def extract_open_cells(spark, d):
    """The same statistics from pages that lack the closing tags of all lines, cells and rows."""
    pages = fight_pages(spark, d).withColumn("html", F.regexp_replace("html", "</(?:p|td|tr|th)>", ""))
    path = shared_folder(spark)
    files.overwrite(extract.fight_sections(pages).filter("readable").select("event", "fight_id", "totals", "strikes"), path)
    good = spark.read.parquet(path)
    keys = ["event", "fight_id"]
    totals = extract.section_rows(good, "totals", TOTALS, keys, by_round=False)
    strikes = extract.section_rows(good, "strikes", STRIKES, keys, by_round=False)
    return left_join(totals, strikes, [*keys, "fighter"])


@check(
    f"""SELECT c_custkey::VARCHAR AS event, 1 AS fight_id, 'Round ' || r AS round, corner || ' ' || c_custkey AS fighter,
    {_values(TOTALS, 0, "(sign || r)")}, {_values(STRIKES, 2, "(sign || r)")}
    FROM (SELECT *, unnest(range(1, c_custkey % 3 + 2)) AS r FROM customer WHERE c_acctbal > 0),
    (VALUES ('Red', ''), ('Blue', '-')) v(corner, sign)"""
)
def extract_round_stats(spark, d):
    good = _sections(spark, d)
    keys = ["event", "fight_id"]
    totals = extract.section_rows(good, "round_totals", TOTALS, keys, by_round=True)
    strikes = extract.section_rows(good, "round_strikes", STRIKES, keys, by_round=True)
    return left_join(totals, strikes, [*keys, "round", "fighter"])


@check("SELECT c_custkey::VARCHAR AS event, c_acctbal > 0 AS readable FROM customer")
def extract_rejects(spark, d):
    """Which fight pages can be read."""
    return extract.fight_sections(fight_pages(spark, d)).select("event", "readable")
