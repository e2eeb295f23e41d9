"""Three runs of the weekly load on pages that Spark writes from the customers: cards of twenty, a fight per customer."""

from pyspark.sql import functions as F

from ringledger.checks.registry import check, table
from ringledger.checks.site import directory_pages, fight_pages, filled_in, pages_of
from ringledger.operators import extract
from ringledger.plans import weekly
from ringledger.schemas import PAGES, WAREHOUSE
from ringledger.session import shared_folder
from ringledger.sources import files, versions
from ringledger.values import CARD_ROW, LIST_CELL, LIST_DATE, LIST_LINK, LIST_PLACE, LIST_ROW

_INDEX, _DIRECTORY = "http://site.test/events?page=", "http://site.test/fighters?page="


def _index(spark, d, upto):
    """The event list as it is when the cards up to a number are there, in pages of fifty."""
    k = F.floor(F.col("c_custkey") / 20).alias("number")
    row = filled_in(
        f'<tr class="{LIST_ROW}"><td class="{LIST_CELL}"><a href="http://site.test/e{{k}}" class="{LIST_LINK}">Card {{k}}</a>'
        f'<span class="{LIST_DATE}">{{date}}</span></td><td class="{LIST_PLACE}">Hall {{k}}</td></tr>',
        k=F.col("number"),
        date=F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("number").cast("int")), "MMMM d, yyyy"),
    )
    cards = table(spark, d, "customer").select(k).distinct().filter(F.col("number") <= upto)
    page = pages_of(cards.select("number", row.alias("row")), 50, f'<tr class="{LIST_ROW}"><td></td></tr>')
    return page.select(F.col("page").alias("page_id"), F.concat(F.lit(_INDEX), "page").alias("url"), "html")


def _pages(spark, d):
    """Event pages, fight pages and the directory."""
    key = F.col("c_custkey")
    row = filled_in(
        f'<tr class="{CARD_ROW} js" data-link="http://site.test/d{{c}}"><td><i class="b-flag"><i class="b-flag__text">win</i></i>'
        '</td><td><p><a class="b-link" href="#">Red {c}</a></p><p><a class="b-link" href="#">Blue {c}</a></p></td><td></td><td></td>'
        "<td></td><td></td><td><p>Open Weight</p></td><td><p>KO/TKO</p><p>Punches</p></td><td><p>1</p></td><td><p>4:00</p></td></tr>",
        c=key,
    )
    rows = table(spark, d, "customer").select(key.alias("number"), row.alias("row"))
    cards = pages_of(rows, 20, f'<tr class="{CARD_ROW}"><th>W/L</th></tr>')
    url = [F.concat(F.lit(u), c) for u, c in (("http://site.test/e", "page"), ("http://site.test/d", "event"), (_DIRECTORY, "page"))]
    parts = [cards, fight_pages(spark, d), directory_pages(spark, d)]
    # a page number for each address, as there is one fetch of each
    parts = [p.select(F.xxhash64(u).alias("page_id"), u.alias("url"), "html") for p, u in zip(parts, url, strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(
    """WITH c AS (SELECT c_custkey, c_custkey // 20 AS k, c_acctbal > 0 AS good, c_mktsegment FROM customer),
    r AS (SELECT CASE WHEN k <= (SELECT max(k) // 2 FROM c) THEN 1 ELSE 2 END AS run, * FROM c),
    people AS (SELECT count(*) AS n FROM c WHERE c_mktsegment <> 'MACHINERY')
    SELECT 'events' AS job, count(DISTINCT k) AS new_rows, 'Card ' || max(k) AS last_key, 'success' AS status FROM r GROUP BY run
    UNION ALL SELECT 'fights', count(*), 'Card ' || max(k), 'success' FROM r GROUP BY run
    UNION ALL SELECT 'stats', 2 * count(*) FILTER (good), 'Card ' || max(k) FILTER (good), 'success' FROM r GROUP BY run
    UNION ALL SELECT job, 0, 'Card ' || k, 'success' FROM (VALUES ('events'), ('fights')) v(job), (SELECT max(k) AS k FROM c)
    UNION ALL SELECT 'stats', 0, 'Card ' || max(k) FILTER (good), 'success' FROM c
    UNION ALL SELECT job, n, NULL, 'success' FROM (SELECT 'fighters' AS job, n FROM people UNION ALL SELECT 'warehouse', 5), range(3)
    UNION ALL SELECT 'notify', (run < 3)::INT, NULL, 'success' FROM range(1, 4) r(run)
    UNION ALL SELECT 'table events', count(DISTINCT k), NULL, NULL FROM c
    UNION ALL SELECT 'table fighters', n, NULL, NULL FROM people
    UNION ALL SELECT 'table fights', count(*), NULL, NULL FROM c
    UNION ALL SELECT 'table fight_stats', 2 * count(*) FILTER (good), NULL, NULL FROM c
    UNION ALL SELECT 'table round_stats', 2 * coalesce(sum(c_custkey % 3 + 1) FILTER (good), 0)::BIGINT, NULL, NULL FROM c"""
)
def weekly_load(spark, d):
    """What three runs write to the audit, and the sizes of the tables. The second run has the later half of the cards, the
    third nothing new: its steps end when they have seen that, and nobody is notified again."""
    base = shared_folder(spark)
    folders = weekly.Folders(f"{base}/league")
    files.overwrite(extract.spread(_pages(spark, d), "url"), f"{base}/pages")
    fetched = spark.read.parquet(f"{base}/pages")
    last = table(spark, d, "customer").agg(F.floor(F.max("c_custkey") / 20).alias("k"))
    signups = table(spark, d, "events").filter("event_type = 'signup'")
    user = F.col("user_id").cast("string")
    log = [user.alias("user_id"), F.lit("").alias("username"), F.lit("subscribe").alias("action")]
    log += [F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.lit(1).alias("subscribe")]
    files.overwrite(signups.select(*log), folders.at("user_actions"))
    for run, upto in (("r1", F.floor(last.scalar() / 2)), ("r2", last.scalar()), ("r3", last.scalar())):
        pages = fetched.unionByName(_index(spark, d, upto)).select([F.col(f.name).cast(f.dataType) for f in PAGES.fields])
        index, directory = F.col("url").startswith(_INDEX), F.col("url").startswith(_DIRECTORY)
        number = F.substring_index("url", "=", -1).cast("bigint")
        weekly.run_weekly(weekly.Job(spark, folders, pages, run, index, directory, number))
    audit = spark.read.parquet(folders.at("run_audit")).select("job", "new_rows", "last_key", "status")
    none = F.lit(None).cast("string")
    for name in WAREHOUSE:
        size = versions.read_current(spark, f"{folders.at('warehouse')}/{name}").agg(F.count(F.lit(1)).alias("new_rows"))
        audit = audit.unionByName(size.select(F.lit(f"table {name}").alias("job"), "new_rows", none.alias("last_key"), none.alias("status")))
    return audit
