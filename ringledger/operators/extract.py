"""Result pages to rows. One lazy job per page kind; a page or row that cannot be read goes to the rejects."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions import html
from ringledger.functions.decode import drop_marks, drop_one_mark
from ringledger.operators.blocks import running_sum
from ringledger.operators.report import result_from_flag
from ringledger.schemas import STRIKES, TOTALS
from ringledger.values import (
    CARD_BODY,
    CARD_CELL,
    CARD_FLAG,
    CARD_LINK,
    CARD_ROW,
    CHAMPION,
    LIST_CELL,
    LIST_DATE,
    LIST_LINK,
    LIST_PLACE,
    LIST_ROW,
    ROW_MARKERS,
)


def few_bytes(df: DataFrame) -> bool:
    """Whether a table has fewer bytes than one partition per core holds."""
    spark = df.sparkSession
    per_task = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    # the planner's estimate, which runs nothing
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size < spark.sparkContext.defaultParallelism * per_task


def over_cores(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table of few bytes is spread over the cores; a larger one has partitions enough and stays as it is.

    Extraction works long on few bytes, so a table of one file would keep most cores idle.
    """
    return over_cores(df, key) if few_bytes(df) else df


def numbered(
    df: DataFrame, items: Column, item: str, number: str, skip: int = 0, oldest_first: bool = False
) -> DataFrame:
    """One row per item after the first `skip`, with its number from 1.

    `oldest_first` counts from the other end, for pages that list the newest first.
    """
    # the outer form, since Spark puts a filter that computes the items once more below the plain one
    counted = df.withColumn("_items", items).withColumn("_n", F.size("_items"))
    rows = counted.select(*df.columns, "_n", F.posexplode_outer("_items").alias("_at", item))
    place = (F.col("_n") - F.col("_at")) if oldest_first else (F.col("_at") + 1 - skip)
    return rows.filter(F.col("_at") >= skip).withColumn(number, place).drop("_n", "_at")


def index_rows(pages: DataFrame, *keep: str) -> DataFrame:
    """Rows of the event list with their `position` in the page, oldest first, and the columns to keep."""
    body = html.first(html.markup(F.col("html")), "tbody")
    rows = html.elements(body, "tr", LIST_ROW)
    return numbered(pages.select(*keep, "html"), rows, "row", "position", skip=1, oldest_first=True).drop("html")


def over_pages(rows: DataFrame, page: str) -> DataFrame:
    """Rows of the pages of one list with their `position` in the whole list; the page of the highest number is the newest.

    What a page adds is the sum of one number per page. `rows` is read several times and should be a stored table.
    """
    sizes = rows.groupBy(page).agg(F.max("position").alias("_size"))
    sums = running_sum(sizes.withColumn("_list", F.lit(0)), F.col("_size"), ["_list"], F.col(page), [page], "_upto")
    before = sums.select(page, (F.col("_upto") - F.col("_size")).alias("_before"))
    return rows.join(before, page).withColumn("position", (F.col("position") + F.col("_before")).cast("int")).drop("_before")


def index_events(pages: DataFrame) -> DataFrame:
    """Event list, oldest first by `position`. `readable` is false where date or place is absent."""
    return events_of_rows(index_rows(pages))


def events_of_rows(rows: DataFrame) -> DataFrame:
    """As `index_events`, from the rows of the list."""
    row = F.col("row")
    parts = rows.select(
        "position",
        html.first(row, "a", LIST_LINK).alias("_link"),
        html.first(row, "span", LIST_DATE).alias("_date"),
        html.first(row, "td", LIST_PLACE).alias("_place"),
    )
    return parts.select(
        html.text(F.col("_link")).alias("event_name"),
        html.text(F.col("_date")).alias("date"),
        html.text(F.col("_place")).alias("location"),
        html.attribute(F.col("_link"), "href").alias("link"),
        "position",
        (F.col("_date").isNotNull() & F.col("_place").isNotNull()).alias("readable"),
    )


def index_links(pages: DataFrame) -> DataFrame:
    """(event_name, link, position) of the event list; rows without an anchor are left out."""
    return links_of_rows(index_rows(pages))


def links_of_rows(rows: DataFrame) -> DataFrame:
    """As `index_links`, from the rows of the list."""
    anchor = html.first(F.col("row"), "a")
    return rows.filter(anchor.isNotNull()).select(
        html.text(anchor).alias("event_name"), html.attribute(anchor, "href").alias("link"), "position"
    )


def directory_fighters(pages: DataFrame) -> DataFrame:
    """Fighter rows of the directory pages; pages without a table and rows with under 11 cells give nothing."""
    body = html.first(html.markup(F.col("html")), "tbody")
    rows = pages.select(F.explode_outer(html.elements(body, "tr", LIST_ROW)).alias("row"))
    # as rows of their own, since Spark would find the cells once more for a filter on a plain column
    cells = rows.select(F.explode_outer(F.array(html.elements(F.col("row"), "td", LIST_CELL))).alias("cells"))
    cells = cells.filter(F.size("cells") >= 11)
    texts = cells.select("cells", F.transform("cells", html.tight_text).alias("t"))

    def t(i: int) -> Column:
        return F.col("t")[i]

    return texts.select(
        t(0).alias("first_name"),
        t(1).alias("last_name"),
        t(2).alias("nickname"),
        drop_one_mark(t(3)).alias("height"),
        t(4).alias("weight"),
        drop_marks(t(5)).alias("reach"),
        t(6).alias("stance"),
        t(7).alias("wins"),
        t(8).alias("losses"),
        t(9).alias("draws"),
        picture_flag(F.col("cells")[10]).alias("belt"),
        html.attribute(html.first(F.col("cells")[0], "a"), "href").alias("link"),
    )


def _card_rows(pages: DataFrame) -> DataFrame:
    """Fight rows of event pages with columns event_name, event_position, fight_id, row."""
    rows = html.elements(html.markup(F.col("html")), "tr", CARD_ROW)
    return numbered(pages.select("event_name", "event_position", "html"), rows, "row", "fight_id", skip=1).drop("html")


def row_flags(row: Column, markers: list[tuple[str, str]] = ROW_MARKERS) -> list[Column]:
    """A 0/1 column for each marker text that a row may hold."""
    return [row.contains(mark).cast("int").alias(flag) for flag, mark in markers]


def picture_flag(cell: Column) -> Column:
    """`Yes` for a cell with a picture, otherwise empty."""
    return F.when(cell.rlike(r"(?i)<img[\s>/]"), CHAMPION).otherwise("")


def card_fights(pages: DataFrame) -> DataFrame:
    """Fights of event pages (event_name, event_position, html). `readable` is false where a needed part is absent."""
    row = F.col("row")
    parsed = _card_rows(pages).select(
        "event_name",
        "event_position",
        "fight_id",
        "row",
        F.transform(html.elements(row, "a", CARD_LINK), html.text).alias("names"),
        html.text(html.first(row, "i", CARD_FLAG)).alias("flag"),
        html.elements(row, "td").alias("cells"),
    )
    method = F.transform(html.elements(F.get("cells", F.lit(7)), "p"), html.text)
    parsed = parsed.withColumn("how", method)
    complete = (F.size("names") >= 2) & (F.size("cells") >= 10) & (F.coalesce(F.size("how"), F.lit(0)) >= 2)
    readable = complete & F.col("flag").isNotNull()
    first = F.get("names", F.lit(0))
    return parsed.select(
        "event_name",
        "fight_id",
        result_from_flag(F.col("flag"), first).alias("fight_result"),
        first.alias("fighter_1"),
        F.get("names", F.lit(1)).alias("fighter_2"),
        html.text(F.get("cells", F.lit(6))).alias("weight_class"),
        F.get("how", F.lit(0)).alias("method"),
        F.get("how", F.lit(1)).alias("description"),
        html.text(F.get("cells", F.lit(8))).alias("round"),
        html.text(F.get("cells", F.lit(9))).alias("time"),
        *row_flags(F.col("row")),
        html.attribute(row, "data-link").alias("fight_stats_link"),
        "event_position",
        F.coalesce(readable, F.lit(False)).alias("readable"),
    )


def card_links(pages: DataFrame) -> DataFrame:
    """(event_name, event_position, fight_id, link) of the fights of event pages."""
    return _card_rows(pages).select(
        "event_name", "event_position", "fight_id", html.attribute(F.col("row"), "data-link").alias("link")
    )


# columns of a statistics section after the fighter column: place of the first value and number of values
_TOTALS_AT = (1, len(TOTALS))
_STRIKES_AT = (3, len(STRIKES))


def _per_fighter(cells: Column, label: Column, at: tuple[int, int]) -> Column:
    """Transposed cells: struct(round, fighter, values) per fighter; NULL if a value is absent."""
    start, count = at
    fighters = F.get(cells, F.lit(0))
    values = F.slice(cells, start + 1, count)
    complete = (F.size(values) == count) & F.forall(values, lambda lines: F.size(lines) >= F.size(fighters))
    rows = F.transform(
        fighters,
        lambda name, i: F.struct(
            label.alias("round"), name.alias("fighter"), F.transform(values, lambda lines: F.get(lines, i)).alias("v")
        ),
    )
    # a row without names has no values to miss
    return F.when(F.size(fighters) == 0, F.slice(rows, 1, 0)).when(complete, rows)


# the word of a heading is written in this case only; its row is the next one, before any other heading
_HEADING = r"<th\b[^>]*>[^<]*(?-i:Round)[^<]*"
_UP_TO_ROW = rf"(?is){_HEADING}(?:<(?!t[hr](?=[\s>/]))[^<]*+)*+"
_HEADED_ROW = _UP_TO_ROW + html.element_pattern("tr")


def _headed(part: Column) -> Column:
    """Label and stacked cells of the row below a round heading."""
    label = html.tight_text(F.regexp_extract(part, f"(?is){_HEADING}", 0))
    row = F.regexp_extract(part, rf"{_UP_TO_ROW}(.*)", 1)
    return F.struct(label.alias("label"), html.stacked_cells(row, CARD_CELL).alias("cells"))


def fight_sections(pages: DataFrame) -> DataFrame:
    """The four sections of fight pages (event, fight_id, html) as arrays.

    `readable` is false if the page has fewer than four sections, or one of them lacks a value, or a round heading has
    no row. The steps are columns, not nested expressions: an array function computes its input again for each use.
    """
    keep = [c for c in pages.columns if c != "html"]
    body = html.elements(html.markup(F.col("html")), "tbody", CARD_BODY)
    b = [F.get("_bodies", F.lit(k)) for k in range(4)]
    headed = {k: F.regexp_extract_all(b[k], F.lit(_HEADED_ROW), F.lit(0)) for k in (1, 3)}
    cells = pages.select(*keep, body.alias("_bodies")).select(
        *keep,
        *[html.stacked_cells(html.first(b[k], "tr", CARD_ROW), CARD_CELL).alias(f"_cells{k}") for k in (0, 2)],
        *[F.transform(headed[k], _headed).alias(f"_cells{k}") for k in (1, 3)],
        *[F.regexp_count(b[k], F.lit(f"(?is){_HEADING}")).alias(f"_headings{k}") for k in (1, 3)],
    )

    def overall(k: int, at: tuple[int, int]) -> Column:
        return _per_fighter(F.col(f"_cells{k}"), F.lit(None).cast("string"), at)

    def per_round(k: int, at: tuple[int, int]) -> Column:
        return F.transform(f"_cells{k}", lambda r: _per_fighter(r["cells"], r["label"], at))

    rows = cells.withColumns(
        {
            "_rows0": overall(0, _TOTALS_AT),
            "_rows1": per_round(1, _TOTALS_AT),
            "_rows2": overall(2, _STRIKES_AT),
            "_rows3": per_round(3, _STRIKES_AT),
        }
    )

    def rounds(k: int) -> Column:
        all_headed = F.size(f"_rows{k}") == F.col(f"_headings{k}")
        return F.when(all_headed & F.forall(f"_rows{k}", lambda r: r.isNotNull()), F.flatten(f"_rows{k}"))

    sections = [
        F.col("_rows0").alias("totals"),
        rounds(1).alias("round_totals"),
        F.col("_rows2").alias("strikes"),
        rounds(3).alias("round_strikes"),
    ]
    # as a row of its own, since Spark would compute the sections many times over for a filter on a plain column
    whole = rows.select(*keep, F.inline_outer(F.array(F.struct(*sections))))
    names = whole.columns[len(keep) :]
    readable = reduce(and_, [F.col(c).isNotNull() for c in names])
    return whole.withColumn("readable", readable)


def section_rows(sections: DataFrame, section: str, names: list[str], keys: list[str], by_round: bool) -> DataFrame:
    """Rows of one section: keys, the round where wanted, the fighter and the named values."""
    rows = sections.select(*keys, F.inline(section))
    label = ["round"] if by_round else []
    return rows.select(*keys, *label, "fighter", *[F.col("v")[i].alias(n) for i, n in enumerate(names)])
