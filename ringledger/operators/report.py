"""Parts of the event report: winner, title, lines, awards and messages."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions.text import filled, title_case
from ringledger.values import (
    AWARDS,
    AWARDS_HEAD,
    CARD_HEAD,
    EVENT_HEAD,
    NO_CONTEST,
    OPEN_CLASS,
    OPEN_CLASS_TITLE,
    TITLE_SUFFIX,
    WIN_FLAG,
)


def result_from_flag(flag: Column, first: Column) -> Column:
    """Recorded result of a fight: the first name on a win, otherwise no contest."""
    return F.when(flag == WIN_FLAG, first).otherwise(NO_CONTEST)


def winner(result: Column, first: Column, second: Column) -> Column:
    """The side that the result names; NULL if it names neither."""
    return F.when(result == first, first).when(result == second, second)


def loser(result: Column, first: Column, second: Column) -> Column:
    return F.when(result == first, second).when(result == second, first)


def title(championship: Column, weight_class: Column) -> Column:
    return F.when((championship == 1) & (weight_class == OPEN_CLASS), OPEN_CLASS_TITLE).when(
        championship == 1, F.concat(weight_class, F.lit(TITLE_SUFFIX))
    )


def matchup(first: Column, second: Column) -> Column:
    """NULL if either name is."""
    return F.concat(first, F.lit(" vs "), second)


def _shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def fight_line(f: dict[str, Column]) -> Column:
    """One line of the card. `f` maps the parts of the line to columns; missing required parts show as None."""
    return F.concat(
        _shown(f["weight_class"]),
        F.lit(" - Winner: <b>"),
        _shown(f["winner"]),
        F.lit("</b> | Loser: "),
        _shown(f["loser"]),
        F.lit(" | "),
        _shown(f["method"]),
        F.when(filled(f["description"]), F.concat(F.lit(" ("), f["description"], F.lit(")"))).otherwise(""),
        F.lit(" R"),
        _shown(f["round"]),
        F.lit(" @ "),
        _shown(f["time"]),
        F.when(filled(f["title"]), F.concat(F.lit(" - "), f["title"])).otherwise(""),
    )


def event_head(name: Column, location: Column, date: Column) -> Column:
    return F.concat(
        F.lit(EVENT_HEAD + "Event: "),
        _shown(name),
        F.lit("\nLocation: "),
        _shown(location),
        F.lit("\nDate: "),
        _shown(date),
    )


def _joined(line: str, separator: str, order: str) -> Column:
    quoted = separator.replace("\n", "\\n")
    return F.expr(f"listagg({line}, '{quoted}') WITHIN GROUP (ORDER BY {order})")


def joined_lines(df: DataFrame, keys: Sequence[str], line: str, separator: str, order: str, name: str) -> DataFrame:
    """Lines of each key as one text. `order` is an SQL sort list over the columns of `df`."""
    return df.groupBy(*keys).agg(_joined(line, separator, order).alias(name))


def _card_line() -> Column:
    names = [F.col("fight_result"), F.col("fighter_1"), F.col("fighter_2")]
    parts = {c: F.col(c) for c in ("weight_class", "method", "description", "round", "time")}
    parts |= {
        "winner": winner(*names),
        "loser": loser(*names),
        "title": title(F.col("championship_fight"), F.col("weight_class")),
    }
    return fight_line(parts)


def card_lines(fights: DataFrame) -> DataFrame:
    """Key, number and line of each fight."""
    return fights.select("event_name", "fight_id", _card_line().alias("line"))


def tagged(df: DataFrame, keep: Sequence[str], tags: Sequence[tuple[Column, str]], value: Column) -> DataFrame:
    """One row per true condition, with its tag and the tag's place in the list; a single scan of `df`."""
    options = [
        F.when(condition, F.struct(F.lit(i).alias("type_no"), F.lit(text).alias("type")))
        for i, (condition, text) in enumerate(tags)
    ]
    picked = F.explode(F.array_compact(F.array(*options))).alias("tag")
    return df.select(*keep, value.alias("matchup"), picked).select(*keep, "tag.type_no", "tag.type", "matchup")


def tagged_by_union(df: DataFrame, tags: Sequence[tuple[Column, str]], value: Column) -> DataFrame:
    """The same rows as `tagged`, one scan per condition."""
    parts = [df.filter(cond).select(F.lit(t).alias("type"), value.alias("matchup")) for cond, t in tags]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def awards(fights: DataFrame) -> DataFrame:
    """Award type and matchup of each awarded fight."""
    tags = [(F.col(flag) == 1, text) for flag, text in AWARDS]
    return tagged(fights, ["event_name", "fight_id"], tags, matchup(F.col("fighter_1"), F.col("fighter_2")))


def award_line(type_: Column, matchup_: Column) -> Column:
    return F.concat(title_case(type_), F.lit(": "), _shown(matchup_))


def report_messages(event: DataFrame, fights: DataFrame) -> DataFrame:
    """Messages of one event: head, card and, if there are any, awards.

    `event` has one row. Columns: event_name, kind (1 to 3), text. Card and awards come from one pass over the fights.
    A card without fights is sent as its head.
    """
    name = event.select("event_name").scalar()
    vs = matchup(F.col("fighter_1"), F.col("fighter_2"))
    won = [F.when(F.col(flag) == 1, award_line(F.lit(text), vs)).alias(flag) for flag, text in AWARDS]
    flags = [flag for flag, _ in AWARDS]
    texts = (
        fights.filter(F.col("event_name") == name)
        .select("fight_id", _card_line().alias("line"), *won)
        .agg(
            _joined("line", "\n\n", "fight_id DESC").alias("card"),
            *[_joined(flag, "\n", "fight_id").alias(flag) for flag in flags],
        )
    )

    def message(kind: int, head: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.concat(F.lit(head), text).alias("text"))

    awards_text = F.concat_ws("\n", *flags)
    messages = F.array(
        message(2, CARD_HEAD, F.coalesce(F.col("card"), F.lit(""))),
        message(3, AWARDS_HEAD, F.when(awards_text != "", awards_text)),
    )
    of_fights = texts.select(name.alias("event_name"), F.inline(messages)).filter("event_name IS NOT NULL AND text IS NOT NULL")
    head = event_head(F.col("event_name"), F.col("location"), F.col("date"))
    return event.select("event_name", F.lit(1).alias("kind"), head.alias("text")).unionByName(of_fights)
