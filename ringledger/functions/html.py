"""Markup fragments as array columns, all in built-in expressions so that no Python worker is needed.

A fragment is the outer text of one element. Elements are found as HTML reads them: a cell, row, item or paragraph without
its closing tag ends where the next one begins or its parent ends, and a table or list inside an element stays whole. One
pattern reads an element from left to right, with a level for each depth of nesting, `DEPTH` of them; the running depth is the
level that the pattern is in, so that a long page costs linear time and no Python worker.
"""

from collections.abc import Callable
from functools import cache
from html.entities import html5, name2codepoint

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ringledger.functions.text import trimmed
from ringledger.values import BLANKS

# Pieces of patterns. Loops are possessive where nothing that follows could match inside them, so that a long tag or
# page is read once from left to right.
# rest of a tag; a quoted value may hold any character
_REST = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
# attributes of a tag before the one that is looked for
_BEFORE = r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*?"""
_TAG = rf"<[/!a-zA-Z]{_REST}>"
_MARK = "\x01"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also inside array functions, where Spark shares nothing."""
    return F.transform(F.array(value), use)[0]


def _class_test(name: str) -> str:
    """Look-ahead inside an opening tag. Two words or more must be the whole attribute, one word any part of it."""
    if " " in name:
        return rf"""(?={_BEFORE}\sclass\s*=\s*["']{name}["'])"""
    return rf"""(?={_BEFORE}\sclass\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'])"""


#: Levels of tables or lists, or of other elements of one name, inside each other; those further in are read as text.
DEPTH = 6
_LISTS = "ul|ol|menu"
_BLOCKS = (
    "address|article|aside|blockquote|center|details|dialog|dir|div|dl|fieldset|figcaption|figure|footer|form|h[1-6]|header|"
    "hgroup|hr|main|menu|nav|ol|p|pre|search|section|summary|table|ul"
)
#: For an element whose closing tag may be missing: opening and closing tags that end it, and containers that hide such tags.
_IMPLIED = {
    "td": ("td|th|tr|thead|tbody|tfoot", "tr|thead|tbody|tfoot|table", "table"),
    "tr": ("tr|thead|tbody|tfoot", "thead|tbody|tfoot|table", "table"),
    "tbody": ("tbody|tfoot", "table", "table"),
    "li": ("li", _LISTS, _LISTS),
    "p": (f"{_BLOCKS}|li|td|th|tr", f"{_BLOCKS}|li|td|th|tr|tbody|body|html", None),
    "a": ("a", "td|th|tr|li|p|div|body|html", None),
}
_IMPLIED["th"], _IMPLIED["thead"], _IMPLIED["tfoot"] = _IMPLIED["td"], _IMPLIED["tbody"], _IMPLIED["tbody"]


def _any_of(names: str) -> str:
    return rf"(?:{names})(?=[\s>/])"


def _whole(names: str, depth: int = DEPTH) -> str:
    """Pattern of an element of one of the names with all elements of these names inside it."""
    inside = rf"<(?!/?{_any_of(names)})"
    if depth > 1:
        inside = rf"(?:{_whole(names, depth - 1)}|{inside})"
    return rf"<{_any_of(names)}{_REST}>[^<]*+(?:{inside}[^<]*+)*+(?:</(?:{names})\s*>)?+"


def _element(tag: str, cls: str | None, implied: bool = True) -> str:
    """Pattern of an element; without `implied`, up to the first closing tag of its name."""
    opening = rf"<{tag}(?=[\s>/]){_class_test(cls) if cls else ''}{_REST}>"
    if not implied:
        return rf"(?i){opening}[^<]*+(?:<(?!/{tag}\s*>)[^<]*+)*+</{tag}\s*>"
    opens, closes, holders = _IMPLIED.get(tag, (tag, tag, tag))
    inside = rf"<(?!{_any_of(opens)}|/{_any_of(f'{tag}|{closes}')})"
    if holders:
        inside = rf"(?:{_whole(holders)}|{inside})"
    return rf"(?i){opening}[^<]*+(?:{inside}[^<]*+)*+(?:</{tag}\s*>)?+"


def markup(page: Column) -> Column:
    """Page text without comments, scripts and styles."""
    return F.regexp_replace(page, r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)", "")


def element_pattern(tag: str) -> str:
    """Pattern of an element, for use inside larger ones that ignore case."""
    return _element(tag, None).removeprefix("(?i)")


def elements(fragment: Column, tag: str, cls: str | None = None, implied: bool = True) -> Column:
    """All elements of a tag that are not inside another one found, in page order.

    Without `implied` an element needs its closing tag and ends at the first one of its name.
    """
    return F.regexp_extract_all(fragment, F.lit(_element(tag, cls, implied)), F.lit(0))


def first(fragment: Column, tag: str, cls: str | None = None) -> Column:
    """First element of a tag, NULL if there is none."""
    found = F.regexp_extract(fragment, _element(tag, cls), 0)
    return _once(found, lambda x: F.when(x != "", x))


def attribute(fragment: Column, name: str) -> Column:
    """Attribute of the fragment's own tag, NULL if it is absent."""
    quoted = rf"""(?is)^<[a-z0-9]+(?=[\s>/]){_BEFORE}\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    # an empty value is found with its quotes, so no text means no attribute
    value = F.regexp_extract(fragment, quoted, 1)
    bare = _once(value, lambda x: F.when(x != "", F.regexp_replace(x, "^[\"']|[\"']$", "")))
    return entities(bare, closed=True)


def _quoted(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + "".join(f"\\u{ord(c):04x}" if c in "\\'" or ord(c) < 32 else c for c in text) + "'"


def _table(pairs: dict[str, str]) -> str:
    """Constant map, written as one text so that it adds one node to the plan."""
    return f"str_to_map({_quoted(chr(1).join(f'{k}{chr(2)}{v}' for k, v in pairs.items()))}, {_quoted(chr(1))}, {_quoted(chr(2))})"


# the names that pages use most, those of HTML 4, and all others; names that need no semicolon are short
_COMMON = {f"{name};": chr(code) for name, code in name2codepoint.items()} | {"apos;": "'"}
_NAMED = {name: text for name, text in html5.items() if name.endswith(";") and name not in _COMMON}
_OPEN = {name: text for name, text in html5.items() if not name.endswith(";")}
_SHORTEST, _LONGEST = min(map(len, _OPEN)), max(map(len, _OPEN))
# byte values that old pages use with the meaning of the Windows code page
_WINDOWS = {str(b): c for b in range(128, 160) if (c := bytes([b]).decode("cp1252", "ignore"))}
_REFERENCE = "&#[0-9]+{end}|&#[xX][0-9a-fA-F]+{end}|&[A-Za-z][A-Za-z0-9]*{end}"


# A reference is decoded by one expression of many parts, which is written in SQL and parsed as a whole: built part by part, it
# would take longer than most queries run.


def _character(digits: str, longest: int, value: str) -> str:
    """The character of a reference by number, as HTML parsers read it; numbers of no character give none. More digits than
    any character has, without leading zeros, stand for a number too large."""
    return rf"""transform(array(CASE WHEN length({digits}) <= {longest} THEN coalesce({value}, 0L) ELSE 1114112L END), _number -> CASE
        WHEN NOT (_number BETWEEN 1 AND 55295 OR _number BETWEEN 57344 AND 1114111) THEN '\ufffd'
        WHEN _number BETWEEN 1 AND 8 OR _number = 11 OR _number BETWEEN 14 AND 31 OR _number = 127
          OR _number BETWEEN 64976 AND 65007 OR _number % 65536 >= 65534 THEN ''
        ELSE coalesce(try_element_at({_table(_WINDOWS)}, CAST(_number AS STRING)),
          decode(unhex(lpad(hex(_number), 8, '0')), 'UTF-32')) END)[0]"""


_DECIMAL, _HEXADECIMAL = (f"regexp_extract(_token, '{p}', 1)" for p in ("^&#0*([0-9]*)", "^&#[xX]0*([0-9a-fA-F]*)"))
#: By name; without a semicolon the longest name that the reference begins with.
_BEGUN = ", ".join(
    f"concat(try_element_at({_table(_OPEN)}, substring(_token, 2, {n})), substring(_token, {n + 2}))"
    for n in range(_LONGEST, _SHORTEST - 1, -1)
)
_ENTITY = rf"""_token -> CASE
    WHEN NOT startswith(_token, '&') THEN _token
    WHEN _token RLIKE '^&#[0-9]' THEN {_character(_DECIMAL, 9, f"try_cast({_DECIMAL} AS BIGINT)")}
    WHEN _token RLIKE '^&#[xX]' THEN {_character(_HEXADECIMAL, 8, f"try_cast(conv({_HEXADECIMAL}, 16, 10) AS BIGINT)")}
    ELSE coalesce(try_element_at({_table(_COMMON)}, substring(_token, 2, 40)),
      try_element_at({_table(_NAMED)}, substring(_token, 2, 40)), {_BEGUN}, _token) END"""


@cache
def _entity(application: str) -> Column:
    """The expression, parsed once for each application."""
    return F.expr(_ENTITY)


def entities(text: Column, closed: bool = False) -> Column:
    """Character references decoded in one pass, so that a decoded `&` starts no other reference.

    All names of HTML 5 and numbers of any length are known. The closing semicolon may be missing unless `closed`, as it
    is for attributes, where `&` also parts parameters.
    """
    reference = _REFERENCE.format(end=";" if closed else ";?")

    def decoded(x: Column) -> Column:
        tokens = F.regexp_extract_all(x, F.lit(f"{reference}|[^&]+|&"), F.lit(0))
        decoded_tokens = F.call_function("transform", tokens, _entity(SparkSession.active().sparkContext.applicationId))
        return F.when(x.contains("&"), F.array_join(decoded_tokens, "")).otherwise(x)

    return _once(text, decoded)


def text(fragment: Column) -> Column:
    """Text of an element, trimmed at both ends only."""
    return trimmed(entities(F.regexp_replace(fragment, _TAG, "")))


def tight_text(fragment: Column) -> Column:
    """Text of an element, every text node trimmed and the nodes joined without a separator."""
    # tags become a mark that is no regular expression, which splits without one
    marked = entities(F.regexp_replace(fragment, _TAG, _MARK))

    def joined(x: Column) -> Column:
        nodes = F.transform(F.split(x, _MARK), lambda node: trimmed(node))
        return F.when(x.contains(_MARK), F.array_join(nodes, "")).otherwise(x)

    return _once(trimmed(marked, also=_MARK), joined)


# a blank; the cheap test comes first, since most characters of a page are printable ASCII
_BLANK = f"[[^!-~]&&[{BLANKS}]]"


def stacked_cells(row: Column, cls: str) -> Column:
    """Cells (`td` of a class) of a row, each as the list of its lines (`p`), in the form of `tight_text`.

    One pass over the whole row turns the tags of cells and lines into a mark with a letter, so that a cell costs one more
    pattern, over what is left, and a line none. A line or cell without its closing tag ends at the next mark. Rows with
    character references, inner tables or other blocks, or with the mark itself, are read line by line.
    """
    # cell, line, end of a line; any other cell, and the begin or end of a row, end a cell. Letters in both cases are faster
    # than a pattern that ignores case.
    marks = (
        rf"<(?:[tT]([dD])(?=[\s>/])(?i:{_class_test(cls)}){_REST}>|([pP])(?=[\s>/]){_REST}>|(/)[pP]\s*>"
        rf"|/([tT])[dDrR]\s*>|([tT])[dDhHrR](?=[\s>/]){_REST}>)"
    )
    line = f"{_MARK}[pP]{_BLANK}*+([^{_MARK}]*[^{BLANKS}{_MARK}])?"

    def in_passes(marked: Column) -> Column:
        # other tags go with the blanks around them; most rows have none
        bare = F.regexp_replace(marked, rf"{_BLANK}*+(?:{_TAG}{_BLANK}*+)+", "")
        bare = F.when(marked.contains("<"), bare).otherwise(marked)
        cells = F.regexp_extract_all(bare, F.lit(f"{_MARK}[dD]((?:[^{_MARK}]++|{_MARK}[pP/])*+)"), F.lit(1))
        return F.transform(cells, lambda c: F.regexp_extract_all(c, F.lit(line), F.lit(1)))

    def line_by_line(x: Column) -> Column:
        return F.transform(elements(x, "td", cls), lambda c: F.transform(elements(c, "p"), tight_text))

    blocks = rf"(?i)<(?:{_BLOCKS.replace('|p|', '|')}|li)(?=[\s>/])"

    def read(x: Column) -> Column:
        def passed(marked: Column) -> Column:
            odd = x.contains("&") | x.contains(_MARK) | (marked.contains("<") & marked.rlike(blocks))
            return F.when(odd, line_by_line(x)).otherwise(in_passes(marked))

        return _once(F.regexp_replace(x, marks, f"{_MARK}$1$2$3$4$5"), passed)

    return _once(row, read)
