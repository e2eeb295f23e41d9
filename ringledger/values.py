"""Texts, markers and page markup names that the results depend on."""

# Cells that mean "no value" in the raw pages.
MISSING = ["---", "--"]
MISSING_IN_FIGHTS = ["---"]

# Columns added to raw tables and recorded results.
NO_CONTEST = "nc"
WIN_FLAG = "win"
CHAMPION = "Yes"
OPEN_CLASS = "Open Weight"
OPEN_CLASS_TITLE = "UFC Championship"
TITLE_SUFFIX = " Championship Fight"

# Award flag column and the award text shown for it, in report order.
AWARDS = [
    ("performance_of_the_night", "Performance of the Night"),
    ("ko_of_the_night", "KO of the Night"),
    ("sub_of_the_night", "Submission of the Night"),
]

# Message heads of the event report.
EVENT_HEAD = "<b>🏟️ Last UFC Event:</b>\n"
CARD_HEAD = "<b>🥊 Fight Card Results:</b>\n"
AWARDS_HEAD = "<b>🏆 Event Highlights:</b>\n"

# Image names inside a fight row and the flag column each one sets.
ROW_MARKERS = [
    ("championship_fight", "belt.png"),
    ("fight_of_the_night", "fight.png"),
    ("performance_of_the_night", "perf.png"),
    ("sub_of_the_night", "sub.png"),
    ("ko_of_the_night", "ko.png"),
]

# Class names in the markup of the result pages.
LIST_ROW = "b-statistics__table-row"
LIST_CELL = "b-statistics__table-col"
LIST_LINK = "b-link b-link_style_black"
LIST_DATE = "b-statistics__date"
LIST_PLACE = "b-statistics__table-col b-statistics__table-col_style_big-top-padding"
CARD_ROW = "b-fight-details__table-row"
CARD_CELL = "b-fight-details__table-col"
CARD_BODY = "b-fight-details__table-body"
CARD_LINK = "b-link"
CARD_FLAG = "b-flag__text"

# Subscription actions.
SUBSCRIBE = "subscribe"
UNSUBSCRIBE = "unsubscribe"

# Conversation limits.
KEPT_MESSAGES = 10
PROMPT_MESSAGES = 3
SUMMARY_MESSAGES = 5
PREVIEW_CHARS = 100

# Characters that count as blank when text is trimmed, as the inside of a pattern's character class: all that are blank
# in Unicode.
BLANKS = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Date text of raw events.
EVENT_DATE_FORMAT = "MMMM d, yyyy"
