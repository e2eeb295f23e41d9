"""Table schemas: warehouse tables, the action message and the run state."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    # StructType.fromDDL needs a running session, which there is none of at import
    fields = [f.split(maxsplit=2) for f in text.split(",")]
    return T.StructType([T.StructField(f[0], _TYPES[f[1]], len(f) == 2) for f in fields])


# Columns and types of the warehouse tables.
EVENTS = _struct("event_name string not null, date date, location string, link string, last_updated timestamp")

FIGHTS = _struct(
    "event_name string not null, fight_id int not null, fight_result string, fighter_1 string, "
    "fighter_2 string, weight_class string, method string, description string, round int, time string, "
    "championship_fight int, fight_of_the_night int, performance_of_the_night int, sub_of_the_night int, "
    "ko_of_the_night int, fight_stats_link string, last_run timestamp"
)

TOTALS = [
    "knockdowns",
    "significant_strikes",
    "significant_strike_accuracy_pct",
    "total_strikes",
    "takedowns",
    "takedown_accuracy_pct",
    "submission_attempts",
    "reversals",
    "control_time",
]
STRIKES = [
    "significant_head_strikes",
    "significant_body_strikes",
    "significant_leg_strikes",
    "distance_strikes",
    "clinch_strikes",
    "ground_strikes",
]
INT_STATS = {"knockdowns", "submission_attempts", "reversals"}
PAIR_STATS = ["significant_strikes", "total_strikes", "takedowns", *STRIKES]
PERCENT_STATS = ["significant_strike_accuracy_pct", "takedown_accuracy_pct"]

_STATS = ", ".join(f"{c} {'int' if c in INT_STATS else 'string'}" for c in TOTALS + STRIKES)
FIGHT_STATS = _struct(f"event string not null, fight_id int not null, fighter string, {_STATS}, last_run timestamp")
ROUND_STATS = _struct(
    f"event string not null, fight_id int not null, round string, fighter string, {_STATS}, last_run timestamp"
)

FIGHTERS = _struct(
    "first_name string, last_name string, nickname string, height string, weight string, reach double, "
    "stance string, wins int, losses int, draws int, belt string, link string, last_run timestamp"
)

ACTION = _struct("user_id string not null, username string, action string, timestamp string, subscribe int")

STATE = _struct("last_run string, duration_s double, last_event string")

AUDIT = _struct(
    "job string, timestamp timestamp, duration_s double, new_rows bigint, last_key string, status string"
)

NOTIFICATIONS = _struct("sent_at timestamp, event_name string, event_date date")

PAGES = _struct("page_id bigint, url string, html string")

WAREHOUSE = {
    "events": EVENTS,
    "fighters": FIGHTERS,
    "fights": FIGHTS,
    "fight_stats": FIGHT_STATS,
    "round_stats": ROUND_STATS,
}
