"""Round trips through files in the shared folder."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.checks.registry import check, table
from ringledger.functions.decode import typed
from ringledger.functions.text import iso_text
from ringledger.schemas import AUDIT
from ringledger.session import shared_folder
from ringledger.sources import files, manifest, tables, versions


@check(
    """SELECT o_orderkey, o_orderdate::DATE AS day, o_totalprice, 'say "' || o_orderpriority || '", twice' AS remark
    FROM orders"""
)
def csv_typed_scan(spark, d):
    path = shared_folder(spark)
    remark = F.concat(F.lit('say "'), "o_orderpriority", F.lit('", twice'))
    long_date = F.date_format("o_orderdate", "MMMM d, yyyy")
    raw = table(spark, d, "orders").select("o_orderkey", long_date.alias("day"), "o_totalprice", remark.alias("remark"))
    files.write_csv(raw, path)
    schema = T.StructType.fromDDL("o_orderkey bigint not null, day date, o_totalprice double, remark string")
    return files.read_csv(spark, path, schema, long_dates=True)


@check("SELECT event_id, user_id, event_type, CASE WHEN event_type IN ('signup', 'error') THEN 'a' ELSE 'b' END AS run FROM events")
def append_increment(spark, d):
    """Two runs, the second one repeated and followed by an empty one."""
    path = shared_folder(spark)
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    files.write_slice(e.filter("event_type IN ('signup', 'error')"), path, "a")
    files.write_slice(e.filter("event_type = 'view'"), path, "b")
    files.write_slice(e.filter("event_type NOT IN ('signup', 'error')"), path, "b")
    files.write_slice(e.filter("event_type = 'none'"), path, "c")
    return files.read_slices(spark, path, e.schema)


@check("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def full_refresh(spark, d):
    path = shared_folder(spark)
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    files.overwrite(c, path)
    files.overwrite(c.filter("c_acctbal > 0"), path)
    return files.read_table(spark, path, c.schema)


@check(
    """SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS last_run, count(*)::DOUBLE AS duration_s,
    arg_max(event_id, ts)::VARCHAR AS last_event FROM events"""
)
def state_roundtrip(spark, d):
    path = shared_folder(spark)
    e = table(spark, d, "events")
    # one row of aggregates is the state that a run leaves
    state = e.agg(
        iso_text(F.max("ts")).alias("last_run"),
        F.count(F.lit(1)).cast("double").alias("duration_s"),
        F.max_by("event_id", "ts").cast("string").alias("last_event"),
    ).first()
    files.write_state(spark, path, *state)
    return files.read_state(spark, path)


@check(
    """SELECT r.run, count(e.event_id) AS new_rows, max(e.event_id)::VARCHAR AS last_key,
    CASE WHEN count(e.event_id) = 0 THEN 'nothing new' ELSE 'success' END AS status
    FROM (SELECT unnest(range(min(ts)::DATE, (max(ts)::DATE + INTERVAL 1 DAY)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS run
      FROM events) r LEFT JOIN events e ON e.ts::DATE = r.run AND e.event_type = 'purchase' AND e.value > 60
    GROUP BY r.run"""
)
def run_audit_counts(spark, d):
    """Rows per daily run; a day without rows is a run with nothing new."""
    e = table(spark, d, "events")
    day = F.to_date("ts")
    counts = (
        e.filter("event_type = 'purchase' AND value > 60")
        .groupBy(day.alias("run"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_key"))
    )
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    audit = e.agg(F.struct(F.min("ts").alias("lo"), F.max("ts").alias("hi")).alias("s"))
    runs = audit.select(F.explode(F.sequence(F.to_date("s.lo"), F.to_date("s.hi"))).alias("run"))
    lines = runs.join(counts, "run", "left").select(
        F.date_format("run", "yyyy-MM-dd").alias("job"),
        F.col("run").alias("timestamp"),
        F.lit(0.0).alias("duration_s"),
        n.alias("new_rows"),
        "last_key",
        F.when(n == 0, "nothing new").otherwise("success").alias("status"),
    )
    path = shared_folder(spark)
    files.append_audit(lines, path)
    return files.read_table(spark, path, AUDIT).select(F.to_date("job").alias("run"), "new_rows", "last_key", "status")


@check(
    """SELECT c_custkey, c_name, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
    c_acctbal, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer"""
)
def warehouse_roundtrip(spark, d):
    """Raw text cells stored, typed on load, and read back through a view."""
    path = shared_folder(spark)
    c = table(spark, d, "customer")
    schema = c.schema
    raw = c.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.when(F.col("c_nationkey") % 5 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    files.write_slice(raw, f"{path}/raw", "1")
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    stored = files.read_slices(spark, f"{path}/raw", text)
    versions.refresh(typed(stored, schema), f"{path}/warehouse/loaded_customer")
    spark = tables.question_session(spark)
    tables.register_views(spark, f"{path}/warehouse", ["loaded_customer"])
    return tables.select(spark, "SELECT * FROM loaded_customer")


@check(
    "SELECT arg_max(event_type, (ts, event_id)) AS last_kind, NULL::VARCHAR AS none FROM events"
)
def bookmark_of_stored_table(spark, d):
    """Bookmark of the newest run that has rows, in the order of the rows' places, from the line of that run; a table that is
    not there has none."""
    path = shared_folder(spark)
    e = table(spark, d, "events").select("event_type", "ts", "event_id")
    for run, rows in {"1": "ts < '2024-01-10'", "2": "ts >= '2024-01-10'", "3": "false"}.items():
        manifest.write_run(e.filter(rows), path, run, "event_type", ["ts", "event_id"])
    stored = manifest.last_of(spark, path).withColumnRenamed("last", "last_kind")
    return stored.withColumn("none", manifest.last_of(spark, f"{path}-absent").scalar())


@check(
    """SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events
    WHERE event_type IN ('signup', 'error', 'purchase') GROUP BY event_type"""
)
def slices_with_lines(spark, d):
    """Slices by kind, one of them stored twice; the lines tell rows and last key without opening a slice."""
    path = shared_folder(spark)
    e = table(spark, d, "events").select("event_id", "event_type", "ts")
    manifest.write_run(e.filter("event_type = 'view'"), path, "purchase", "event_id", ["event_id"])
    for kind in ("signup", "error", "purchase", "none"):
        manifest.write_run(e.filter(F.col("event_type") == kind), path, kind, "event_id", ["event_id"])
    lines = spark.read.schema(manifest.LINE).option("basePath", f"{path}/{manifest.RUNS}/filled")
    lines = lines.json(f"{path}/{manifest.RUNS}/filled").withColumn("event_type", F.regexp_extract(F.input_file_name(), "run=([a-z]+)", 1))
    return lines.select("event_type", F.col("rows").alias("n"), F.col("last").cast("bigint").alias("last_id"))


@check("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def refresh_that_fails(spark, d):
    """Two refreshes, and a third that breaks on the way: readers keep the second version."""
    path = shared_folder(spark)
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    versions.refresh(c, path)
    versions.refresh(c.filter("c_acctbal > 0"), path)
    broken = F.when(F.col("c_acctbal") < 0, F.raise_error(F.lit("broken row"))).otherwise(F.col("c_name"))
    try:
        versions.refresh(c.withColumn("c_name", broken.cast("string")), path)
    except Exception as e:
        if "broken row" not in str(e):
            raise
    return versions.read_current(spark, path)
