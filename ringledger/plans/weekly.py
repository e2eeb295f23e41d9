"""The weekly load: event list, fighters, fights, statistics, warehouse tables, notification.

Input is a table of fetched pages (url, html). Each step reads what the earlier ones stored, selects what is new by
its bookmarks, and writes one slice per run, so that any step can be repeated alone.
"""

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.functions.decode import missing_to_null
from ringledger.operators import extract
from ringledger.operators.incremental import gap_after_done, gap_up_to_known, not_yet_stored, since_bookmark
from ringledger.operators.joins import left_join
from ringledger.operators.latest import last_value, newest_slice
from ringledger.plans.report import notify, streamed_subscribers, subscribers
from ringledger.schemas import ACTION, EVENTS, FIGHT_STATS, FIGHTERS, FIGHTS, ROUND_STATS, STRIKES, TOTALS, WAREHOUSE
from ringledger.sources import files, manifest, versions
from ringledger.sources.tables import warehouse_frames
from ringledger.values import MISSING, MISSING_IN_FIGHTS


def _raw(schema: T.StructType, *extra: str) -> T.StructType:
    """Schema of a raw table: text columns, and whole-number places that keep the order of the pages."""
    texts = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    return T.StructType([*texts, *[T.StructField(e, T.IntegerType()) for e in extra]])


RAW = {
    "events": _raw(EVENTS, "position"),
    "fighters": _raw(FIGHTERS),
    "fights": _raw(FIGHTS, "event_position"),
    "fight_stats": _raw(FIGHT_STATS, "event_position"),
    "round_stats": _raw(ROUND_STATS, "event_position"),
}
# the value that bookmarks are made of, and its place in the order of the rows
MARKS = {
    "events": ("event_name", "position"),
    "fights": ("event_name", "event_position"),
    "fight_stats": ("event", "event_position"),
}
# all that a row of the event list says: rows without a link have no name
EVENT_KEY = ["event_name", "date", "location", "link"]


@dataclass(frozen=True)
class Folders:
    """Where the tables of one deployment are, all below one shared folder."""

    base: str

    def raw(self, table: str) -> str:
        return f"{self.base}/raw/{table}"

    def at(self, name: str) -> str:
        return f"{self.base}/{name}"


@dataclass
class Job:
    """One run: session, folders, fetched pages and the run id. Run ids must sort in run order.

    `index` and `directory` pick the event list and the fighter directory among the pages. A list of several pages needs
    `index_page`, a whole number from a page's address that is higher for the pages of newer events.
    """

    spark: SparkSession
    folders: Folders
    pages: DataFrame
    run: str
    index: Column
    directory: Column
    index_page: Column | None = None

    def __post_init__(self) -> None:
        self.few_pages = extract.few_bytes(self.pages)

    def fetched(self, pages: DataFrame, keys: list[str], wanted: DataFrame | None = None) -> DataFrame:
        """As `_newest_fetch`. Few pages are spread over the cores by their keys, which no two of them share."""
        newest = _newest_fetch(pages, keys, wanted)
        return extract.over_cores(newest, *keys) if self.few_pages else newest

    def stored(self, table: str, runs: Column) -> DataFrame:
        return files.read_slices(self.spark, self.folders.raw(table), RAW[table]).filter(runs)

    def earlier(self, table: str) -> DataFrame:
        """What was there before this run, also if the run is repeated."""
        return self.stored(table, F.col("run") < self.run)

    def up_to_now(self, table: str) -> DataFrame:
        return self.stored(table, F.col("run") <= self.run)

    def last(self, rows: DataFrame, value: str, place: str) -> DataFrame:
        """Value of the last row of a raw table: only the newest run that has rows is read for it."""
        return last_value(newest_slice(rows, "run"), value, ["run", place])

    def mark(self, table: str, earlier: bool = False) -> str | None:
        """Value of the last stored row, of this run and those before it or only those: from the line of one run."""
        path = self.folders.raw(table)
        if manifest.has_lines(self.spark, path):
            upto, before = (None, self.run) if earlier else (self.run, None)
            return _value(manifest.last_of(self.spark, path, upto, before))
        rows = self.earlier(table) if earlier else self.up_to_now(table)  # slices from before there were lines
        return _value(self.last(rows, *MARKS[table]))

    def other_runs(self, table: str) -> DataFrame:
        return self.stored(table, F.col("run") != self.run)

    def store(self, df: DataFrame, table: str) -> int:
        """Write this run's slice with its line; the number of rows."""
        schema = RAW[table]
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        value, place = MARKS.get(table, (None, None))
        return manifest.write_run(rows, self.folders.raw(table), self.run, value, [place] if place else None)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table that several steps of this run read."""
        path = f"{self.folders.at('staging')}/{name}/run={self.run}"
        files.overwrite(df, path)
        return self.spark.read.parquet(path)

    def has_staged(self, name: str) -> bool:
        return files.exists(self.spark, f"{self.folders.at('staging')}/{name}/run={self.run}/_SUCCESS")

    def staged(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folders.at('staging')}/{name}/run={self.run}")

    def reject(self, df: DataFrame, job: str) -> None:
        rows = df.select(F.lit(job).alias("job"), "key", "reason")
        files.write_slice(rows, f"{self.folders.at('rejects')}/job={job}", self.run)

    def last_run(self) -> str:
        """Time of the last run that found a new event; later steps stamp their rows with it."""
        row = files.read_state(self.spark, self.folders.at("state")).select("last_run").first()
        if row is None:
            raise ValueError("no run state: the event step has to find an event first")
        return row[0]

    def audit(self, job: str, started: float, new_rows: int, last_key: str | None, status: str = "success") -> None:
        path = self.folders.at("run_audit")
        files.write_audit(self.spark, path, job, time.time() - started, new_rows, last_key, status)


def _value(df: DataFrame):
    """The value of a one-row aggregate."""
    return df.first()[0]


def _newest_fetch(pages: DataFrame, keys: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """The keys and the markup of one page per key, the one fetched last.

    `wanted` has the keys and the addresses (url) that are looked for; without it the keys are columns of the pages. The
    choice is made on page numbers, and the markup is joined to the chosen numbers once.
    """
    narrow = pages.select("page_id", "url")
    narrow = narrow.join(wanted, "url") if wanted is not None else narrow
    newest = narrow.groupBy(*keys).agg(F.max_by("url", "page_id").alias("_url"), F.max("page_id").alias("_page"))
    whole = pages.select(F.col("page_id").alias("_page"), F.col("url").alias("_url"), "html")
    return whole.join(newest, ["_page", "_url"]).select(*keys, "html")


def load_events(job: Job) -> int:
    started = time.time()
    index = job.fetched(job.pages.filter(job.index), ["url"])
    if job.index_page is None:
        list_rows = extract.index_rows(index)
    else:
        numbered = index.withColumn("page", job.index_page.cast("bigint"))
        in_page = job.stage(extract.index_rows(numbered, "page"), "list_pages")
        list_rows = extract.over_pages(in_page, "page")
    list_rows = job.stage(list_rows, "list_rows")
    # the later steps need the same list, by any link of a row
    job.stage(extract.links_of_rows(list_rows), "links")
    listed = job.stage(extract.events_of_rows(list_rows), "events")
    place = F.concat_ws("#", F.lit("index"), "position").alias("key")
    unreadable = listed.filter(~F.col("readable")).select(place, F.lit("no date or place").alias("reason"))
    if job.index_page is not None:
        # of a list of one page, an empty one is an empty list
        lost = numbered.join(in_page.select("page").distinct(), "page", "left_anti")
        unreadable = unreadable.unionByName(lost.select(F.col("url").alias("key"), F.lit("no rows in list page").alias("reason")))
    job.reject(unreadable, "events")
    listed = listed.filter("readable")
    new = since_bookmark(listed, "event_name", "position", job.mark("events", earlier=True))
    new = not_yet_stored(missing_to_null(new, MISSING), job.other_runs("events"), EVENT_KEY)
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    n = job.store(files.stamped(new, "last_updated", now), "events")
    newest = _value(last_value(listed, "event_name", ["position"]))
    if n:
        files.write_state(job.spark, job.folders.at("state"), now, time.time() - started, newest)
    job.audit("events", started, n, newest)
    return n


def load_fighters(job: Job) -> int:
    """Full refresh: the directory is read whole in each run, and stored beside the runs before it.

    Readers take the newest run that has fighters, so the table is switched by the finished write of a slice.
    """
    started = time.time()
    pages = job.fetched(job.pages.filter(job.directory), ["url"])
    rows = files.stamped(missing_to_null(extract.directory_fighters(pages), MISSING), "last_run", job.last_run())
    rows = job.stage(rows, "fighters")
    if rows.isEmpty():
        # a run that fetched no directory page says nothing about the fighters
        lost = job.spark.createDataFrame([("directory", "no readable directory page")], "key string, reason string")
        job.reject(lost, "fighters")
        job.audit("fighters", started, 0, None, "nothing fetched")
        return 0
    n = job.store(rows, "fighters")
    job.audit("fighters", started, n, None)
    return n


def _event_pages(job: Job, events: DataFrame) -> DataFrame:
    """Pages of the given events. Spark filters the page table by the few wanted addresses."""
    wanted = events.select("event_name", F.col("position").alias("event_position"), F.col("link").alias("url"))
    return job.fetched(job.pages, ["event_name", "event_position"], wanted)


def load_fights(job: Job) -> int:
    started = time.time()
    upstream, done = job.mark("events"), job.mark("fights", earlier=True)
    new = gap_after_done(job.staged("links"), "event_name", "position", upstream, done)
    new = job.stage(new, "new_events")
    if new.isEmpty():
        job.audit("fights", started, 0, job.mark("fights"))
        return 0
    rows = job.stage(extract.card_fights(_event_pages(job, new)), "fights")
    unreadable = F.concat_ws("#", "event_name", "fight_id").alias("key")
    unreadable = rows.filter(~F.col("readable")).select(unreadable, F.lit("part of fight row absent").alias("reason"))
    # the few new addresses are looked up in the page table, not the other way round
    fetched = job.pages.select(F.col("url").alias("link")).join(new.select("link"), "link", "left_semi")
    missing = new.join(fetched, "link", "left_anti")
    missing = missing.select(F.col("event_name").alias("key"), F.lit("no page").alias("reason"))
    job.reject(unreadable.unionByName(missing), "fights")
    kept = missing_to_null(rows.filter("readable"), MISSING_IN_FIGHTS)
    kept = kept.withColumn("fight_id", F.col("fight_id").cast("string"))
    kept = not_yet_stored(kept, job.other_runs("fights"), ["event_name", "fight_id", "fight_stats_link"])
    n = job.store(files.stamped(kept, "last_run", job.last_run()), "fights")
    job.audit("fights", started, n, job.mark("fights"))
    return n


def _card_links(job: Job, events: DataFrame) -> DataFrame:
    """Number and address of each fight of the given events, from the cards that this run has read already where it has."""
    columns = ["event_name", "event_position", "fight_id", "link"]
    if not job.has_staged("fights"):
        return extract.card_links(_event_pages(job, events)).select(columns)
    cards = job.staged("fights").withColumnRenamed("fight_stats_link", "link").select(columns)
    known = cards.select("event_name", F.col("event_position").alias("position")).distinct()
    read = cards.join(events.select("event_name", F.col("position").alias("event_position")), ["event_name", "event_position"])
    others = events.join(known, ["event_name", "position"], "left_anti")
    return read.select(columns).unionByName(extract.card_links(_event_pages(job, others)).select(columns))


def load_stats(job: Job) -> int:
    started = time.time()
    upstream, done = job.mark("fights"), job.mark("fight_stats", earlier=True)
    new = job.stage(gap_up_to_known(job.staged("links"), "event_name", "position", upstream, done), "stats_events")
    if new.isEmpty():
        job.audit("stats", started, 0, job.mark("fight_stats"))
        return 0
    links = _card_links(job, new).withColumnRenamed("event_name", "event")
    keys = ["event", "event_position", "fight_id"]
    links = job.stage(links.withColumn("fight_id", F.col("fight_id").cast("string")), "fight_links")
    pages = job.fetched(job.pages, keys, links.withColumnRenamed("link", "url"))
    # four tables come from each page: the sections are stored once and read four times
    sections = job.stage(extract.fight_sections(pages), "sections")
    key = F.concat_ws("#", "event", "fight_id").alias("key")
    unread = sections.filter(~F.col("readable")).select(key, F.lit("page not readable").alias("reason"))
    missing = links.join(sections, keys, "left_anti").select(key, F.lit("no page").alias("reason"))
    job.reject(unread.unionByName(missing), "stats")
    good = sections.filter("readable")
    last_run = job.last_run()

    def table(totals: str, strikes: str, by_round: bool, name: str) -> int:
        left = extract.section_rows(good, totals, TOTALS, keys, by_round)
        right = extract.section_rows(good, strikes, STRIKES, keys, by_round).drop("event_position")
        on = ["event", "fight_id", *(["round"] if by_round else []), "fighter"]
        rows = missing_to_null(left_join(left, right, on), MISSING)
        rows = not_yet_stored(rows, job.other_runs(name), on)
        return job.store(files.stamped(rows, "last_run", last_run), name)

    n = table("totals", "strikes", False, "fight_stats")
    table("round_totals", "round_strikes", True, "round_stats")
    job.audit("stats", started, n, job.mark("fight_stats"))
    return n


def load_warehouse(job: Job, write: Callable[[DataFrame, str], None] | None = None) -> int:
    """Refresh the five typed tables, as versions below the warehouse folder or through `write(df, table)`.

    A table is switched when its new version is whole, so that readers always find one.
    """
    started = time.time()
    raw = {t: job.up_to_now(t) for t in WAREHOUSE}
    raw["fighters"] = newest_slice(raw["fighters"], "run")
    write = write or (lambda df, table: versions.refresh(df, f"{job.folders.at('warehouse')}/{table}"))
    for name, df in warehouse_frames(raw).items():
        write(df, name)
    job.audit("warehouse", started, len(WAREHOUSE), None)
    return len(WAREHOUSE)


def send_report(job: Job) -> int:
    started = time.time()
    at = job.folders.at
    if files.exists(job.spark, at("subscriber_state")):
        users = streamed_subscribers(job.spark, at("subscriber_state"))
    else:
        users = subscribers(files.read_table(job.spark, at("user_actions"), ACTION))
    sent = notify(job.spark, at("warehouse"), users, at("notifications"), at("outbox"))
    job.audit("notify", started, int(sent), None)
    return int(sent)


STEPS = {
    "events": load_events,
    "fighters": load_fighters,
    "fights": load_fights,
    "stats": load_stats,
    "warehouse": load_warehouse,
    "notify": send_report,
}


def run_weekly(job: Job) -> dict[str, int]:
    """All steps in order. A failing step is audited and stops the run."""
    counts = {}
    for name, step in STEPS.items():
        started = time.time()
        try:
            counts[name] = step(job)
        except Exception as e:
            job.audit(name, started, 0, None, f"failed: {e}")
            raise
    return counts
