"""SQL over the stored tables: views, one bounded SELECT, and the last result as a view."""

import re
import uuid
from collections.abc import Iterable, Iterator, Mapping

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.functions.decode import typed
from ringledger.schemas import WAREHOUSE
from ringledger.sources.files import exists
from ringledger.sources.versions import read_current

LAST_RESULT = "last_query_result"
NO_ROWS = "No results found."


def register_views(spark: SparkSession, folder: str, names: Iterable[str] = tuple(WAREHOUSE), suffix: str = "") -> None:
    """Register `folder/<name><suffix>`, as it was last committed, as a view of that name."""
    for name in names:
        read_current(spark, f"{folder}/{name}{suffix}").createOrReplaceTempView(name)


# Functions that run code of the machine, and the settings that questions depend on.
REFUSED = ["reflect", "try_reflect", "java_method"]
NEEDED = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.runSQLOnFiles": "false",
}


def question_session(spark: SparkSession) -> SparkSession:
    """A session beside the given one for the questions of one user: with the settings they need and views of its own."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    for key, value in NEEDED.items():
        session.conf.set(key, value)
    return session


def _verify_settings(spark: SparkSession) -> None:
    wrong = [f"{k} = {v}" for k, v in NEEDED.items() if spark.conf.get(k).lower() != v]
    if wrong:
        raise ValueError(f"questions need a session with {', '.join(wrong)}")


def _parts(spark: SparkSession, plan: JavaObject) -> Iterator[tuple[JavaObject, bool]]:
    """All nodes of a plan and of the subqueries in it, and all their expressions, marked as such; a plan's text leaves out
    those of wide nodes."""
    gateway, package = spark.sparkContext._gateway, "org.apache.spark.sql.catalyst.expressions"
    left = [plan]
    while left:
        node = left.pop()
        is_expression = is_instance_of(gateway, node, f"{package}.Expression")
        yield node, is_expression
        parts = [node.children()]
        if not is_expression:
            parts.append(node.expressions())
        elif is_instance_of(gateway, node, f"{package}.PlanExpression"):
            left.append(node.plan())
        left += [p.apply(i) for p in parts for i in range(p.length())]


def _one_row(plan: JavaObject) -> bool:
    most = plan.maxRows()
    return most.isDefined() and most.get() <= 1


def _equates(term: JavaObject, left: JavaObject, right: JavaObject) -> bool:
    """Whether a condition demands that something of one side equals something of the other."""
    if term.nodeName() == "And":
        return _equates(term.left(), left, right) or _equates(term.right(), left, right)
    if term.nodeName() not in ("EqualTo", "EqualNullSafe"):
        return False
    one, other = term.left().references(), term.right().references()
    if one.isEmpty() or other.isEmpty():
        return False
    a, b = left.outputSet(), right.outputSet()
    return (one.subsetOf(a) and other.subsetOf(b)) or (one.subsetOf(b) and other.subsetOf(a))


def _verify_cost(result: DataFrame, most_bytes: int | None) -> None:
    """Refuse products of tables, and scans of more than `most_bytes` together, before anything runs.

    A join needs an equality between its sides, unless one of them is a single row. Sizes are the planner's estimates, after
    filters on partitions and columns have been pushed into the scans.
    """
    scanned = 0
    for node, is_expression in _parts(result.sparkSession, result._jdf.queryExecution().optimizedPlan()):
        if is_expression:
            continue
        if node.nodeName() == "Join" and not (_one_row(node.left()) or _one_row(node.right())):
            condition = node.condition()
            if condition.isEmpty() or not _equates(condition.get(), node.left(), node.right()):
                raise PermissionError("not allowed in a question: a join of two tables without an equality between them")
        if node.children().isEmpty():
            scanned += int(node.stats().sizeInBytes())
    if most_bytes is not None and scanned > most_bytes:
        raise PermissionError(f"a question may read {most_bytes} bytes, this one would read about {scanned}")


def _verify_plan(result: DataFrame, views: Iterable[str] | None) -> None:
    """Refuse what the analysed plan reads besides views, and calls of the machine."""
    analysed = result._jdf.queryExecution().analyzed()
    if found := {e.prettyName() for e, is_expression in _parts(result.sparkSession, analysed) if is_expression} & set(REFUSED):
        raise PermissionError(f"not allowed in a question: {', '.join(sorted(found))}")
    # a node's text begins with the name of what it reads, and subqueries have lines of their own
    plan = analysed.toString()
    if found := re.findall(r"(?:SubqueryAlias|Relation|RelationV2) (spark_catalog\.\S+)", plan):
        raise PermissionError(f"not a registered view: {', '.join(sorted(set(found)))}")
    used = set(re.findall(r"View \(`([^`]+)`", plan))
    if views is not None and (found := used - {*views, LAST_RESULT}):
        raise PermissionError(f"not a view of this question: {', '.join(sorted(found))}")


def select(
    spark: SparkSession,
    sql: str,
    args: Mapping | None = None,
    views: Iterable[str] | None = None,
    most_bytes: int | None = None,
) -> DataFrame:
    """One SELECT over registered views, of the session or only the given ones.

    Commands and several statements are syntax errors inside a subquery and never run. Files by path, catalog tables, calls
    of the machine and products of tables are refused, and scans over `most_bytes`. The session must have the settings in `NEEDED`, as `build_session` makes it:
    otherwise a quoted column name would silently be text.
    """
    _verify_settings(spark)
    result = spark.sql(f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n) AS answer", args=dict(args or {}))
    _verify_plan(result, views)
    _verify_cost(result, most_bytes)
    return result


def last_result(spark: SparkSession, store: str) -> DataFrame | None:
    """The last result with rows that was stored below `store`, the shared folder of one user."""
    if not exists(spark, f"{store}/last"):
        return None
    return spark.read.parquet(spark.read.text(f"{store}/last").first()[0])


def answer(
    spark: SparkSession,
    sql: str,
    store: str,
    args: Mapping | None = None,
    views: Iterable[str] | None = None,
    most_bytes: int | None = None,
) -> DataFrame:
    """As `select`, run once and stored below `store`, the shared folder of one user.

    The question sees the user's last result as the view `last_query_result`; a result with rows takes its place, an empty
    one leaves it.
    """
    before = last_result(spark, store)
    if before is not None:
        before.createOrReplaceTempView(LAST_RESULT)
    result = select(spark, sql, args, views, most_bytes)
    names = [n if result.columns.index(n) == i else f"{n}_{i + 1}" for i, n in enumerate(result.columns)]
    result = result.toDF(*names)  # a question may name two columns alike, a stored table may not
    path = f"{store}/{uuid.uuid4().hex}"
    result.withColumns({n: F.col(f"`{n}`").cast("string") for n, kind in result.dtypes if kind == "void"}).write.parquet(path)
    result = spark.read.parquet(path)
    if not result.isEmpty():
        spark.createDataFrame([(path,)], "value string").coalesce(1).write.mode("overwrite").text(f"{store}/last")
    return result


def records(result: DataFrame) -> DataFrame:
    """Each row as one JSON record keyed by column name; NULL values are kept."""
    return result.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def records_or_message(result: DataFrame) -> DataFrame:
    """The records, or one row with the message for an empty result; `result` should be a stored one, as of `answer`."""
    rows = records(result)
    none = result.limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(NO_ROWS).alias("record"))
    return rows.unionByName(none)


def create_actions_table(spark: SparkSession, table: str = "user_actions", location: str | None = None) -> None:
    """Create the action log table if it is missing."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} "
        f"(user_id STRING, username STRING, action STRING, timestamp STRING, subscribe INT) USING parquet{place}"
    )


def warehouse_frames(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw text tables with the types of the warehouse."""
    return {name: typed(raw[name], schema) for name, schema in WAREHOUSE.items()}
