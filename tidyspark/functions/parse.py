"""Free-text parsers as built-in column expressions.

Each parser returns Columns (structs for multi-part results) built only from
``pyspark.sql.functions``: regexes, ``split``, ``substring_index``,
higher-order ``transform``/``filter`` and ``try_*`` casts, so malformed input
gives NULL under ANSI mode instead of failing the job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyspark.functions.text import MISSING

# --- fixed values ---------------------------------------------------------------
# One list item: runs without comma or "(", and parentheticals (so commas inside
# parentheses do not split; an unclosed one reaches to the end). Possessive runs
# keep the matcher's stack flat for items of any length.
ITEM_OUTSIDE_PARENS = r"(?:[^,(]++|\([^)]*+\)?)++"
# A parenthetical note and its body.
PAREN_NOTE = r"\([^)]*\)"
PAREN_BODY = r"\(([^)]*)\)"
# An item whose only note ends it.
ONE_NOTE = r"^[^()]*+\([^()]*+\)\z"
# A parenthesis opened before the last one was closed: the three patterns above don't hold there.
NESTED = r"\([^)]*\("
# Markers of a list and the runs between them.
MARKERS_AND_RUNS = r"[(),]|[^(),]++"
# Clause words that start an observation ("mild but damp", "mild with showers").
CLAUSE_WORDS = ("but", "with")
# A number with its sign (the dash of "20-30" is none).
WHOLE = r"(?:(?<![\w.)])[+-])?\d+"
# A number, its decimals and a suffix such as "-ish", before a unit in any case.
MEASURE = "(" + WHOLE + r")(?:\.\d+)?(?:-?[A-Za-z]+)?\s*(?i)"
# Unit that follows a temperature.
TEMPERATURE_UNIT = "degrees"
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- dates and times -------------------------------------------------------------

def parse_date(c, fmt: str, pivot_year: int | None = None) -> Column:
    """Text -> DATE with an explicit format; unparsable -> NULL.

    Two-digit years (``yy``) are read by Spark as 2000-2099. ``pivot_year``
    moves years above the pivot back one century (e.g. pivot 2049 reads 98 as
    1998).
    """
    d = F.try_to_date(_c(c), fmt)
    if pivot_year is not None:
        d = F.when(F.year(d) > pivot_year, F.add_months(d, -1200)).otherwise(d)
    return d


def format_date(c, fmt: str = "dd/MM/yyyy") -> Column:
    return F.date_format(_c(c), fmt)


def parse_time(c, fmt: str = "h:mm:ss a", out: str = "HH:mm:ss") -> Column:
    """12-hour clock text -> 24-hour text ``HH:mm:ss``; unparsable -> NULL."""
    return F.date_format(F.try_to_timestamp(_c(c), F.lit(fmt)), out)


def seconds_of_day(c, fmt: str = "HH:mm:ss") -> Column:
    # as a lambda's variable the text is parsed once, not for each part of the time
    return F.get(F.transform(F.array(F.try_to_timestamp(_c(c), F.lit(fmt))),
                             lambda ts: F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)), 0)


def minutes_between(start, end, fmt: str = "HH:mm:ss") -> Column:
    """Whole minutes from ``start`` to ``end`` (times of day); past midnight wraps."""
    diff = F.pmod(seconds_of_day(end, fmt) - seconds_of_day(start, fmt), F.lit(86400))
    return F.floor(diff / 60).cast("int")


def fill_minutes(minutes, start, end, fmt: str = "HH:mm:ss") -> Column:
    """Stated duration (whole minutes of "12.5") if it is a number, else the minutes between the two times."""
    stated = F.regexp_extract(F.trim(_c(minutes)), r"^([+-]?\d+)(?:\.\d*)?$", 1).try_cast("int")
    return F.coalesce(stated, minutes_between(start, end, fmt))


# -- numbers -----------------------------------------------------------------------

def parse_range(c, default: int | None = None) -> Column:
    """Height-like cell -> struct(min, max).

    ``"10-20"``, ``"8 or 10"`` -> (smallest, largest number); ``"<30"`` -> (0, 30);
    ``">30"`` -> (30, NULL); no number -> (default, default).
    """
    def once(s: Column) -> Column:
        return F.get(F.transform(F.array(range_numbers(s)), lambda found: range_of(s, found, default)), 0)

    # the cell, whatever made it, and its numbers are lambdas' variables: evaluated once
    return F.get(F.transform(F.array(_c(c)), once), 0)


def range_numbers(c) -> Column:
    """The whole numbers of a height-like cell."""
    return F.regexp_extract_all(_c(c), F.lit(r"\d+"), 0).try_cast("array<int>")


def range_of(c, numbers, default: int | None = None) -> Column:
    """``parse_range`` of a cell whose ``numbers`` are found (a stored column is quicker than a lambda's variable)."""
    s, nums = _c(c), _c(numbers)
    lo, hi = F.array_min(nums), F.array_max(nums)
    has_num = F.size(nums) > 0
    mn = (F.when(~has_num, F.lit(default).cast("int"))
          .when(s.contains("<"), F.lit(0)).otherwise(lo))
    mx = (F.when(~has_num, F.lit(default).cast("int"))
          .when(s.contains(">") & ~s.contains("<"), F.lit(None).cast("int")).otherwise(hi))
    return _fields(min=mn, max=mx)


def extract_number(c, unit: str | None = TEMPERATURE_UNIT, fallback: bool = False, type_: str = "int") -> Column:
    """The number written before ``unit`` ("43 Degrees", "-5 degrees", "40-ish degrees"); NULL if none.

    ``type_="int"`` gives its whole part, ``"double"`` also its decimals. With
    ``fallback`` the first number anywhere is used when no unit follows.
    """
    s = _c(c)
    whole, measure = WHOLE, MEASURE
    if type_ != "int":
        whole = WHOLE + r"(?:\.\d+)?"
        measure = MEASURE.replace("(" + WHOLE + r")(?:\.\d+)?", "(" + whole + ")")
    first = F.regexp_extract(s, "(" + whole + ")", 1).try_cast(type_)
    if unit is None:
        return first
    before_unit = F.regexp_extract(s, measure + unit, 1).try_cast(type_)
    return F.coalesce(before_unit, first) if fallback else before_unit


# -- structure ----------------------------------------------------------------------

def split_head_tail(c, sep: str = ",") -> Column:
    """struct(head, tail): text before the first ``sep`` and the trimmed rest ('' if none)."""
    s = _c(c)
    pos = F.instr(s, sep)
    head = F.trim(F.substring_index(s, sep, 1))
    tail = F.when(pos > 0, F.trim(F.substr(s, pos + len(sep)))).otherwise(F.lit(""))
    return F.struct(head.alias("head"), tail.alias("tail"))


# Nested parentheses: the cell is cut into markers and runs once, and a running depth
# goes over these pieces. The expressions are written as SQL texts of one argument,
# since their many nested lambdas are built in one call that way; a value that
# several steps need is bound to a lambda's variable and evaluated once a row.

CHUNK = 256                  # pieces whose depths are found from one starting depth


def _let(value: str, name: str, then: str) -> str:
    """``then`` with ``name`` standing for ``value``."""
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def running_depth(deltas: str) -> str:
    """SQL text: the depth before each of an array's steps (+1, 0, -1), never under zero.

    A closing parenthesis without an opening one leaves the depth at zero. Arrays can
    only grow by copying, so they grow a chunk at a time: a chunk takes a depth d to
    max(fin, d + sum), where fin is its result from depth zero; starting depths follow
    from these pairs, and each chunk then counts from its own.
    """
    step = "(a, v) -> greatest(a + v, 0)"
    grown = "aggregate(c, array(d), (a, v) -> array_append(a, greatest(element_at(a, -1) + v, 0)))"
    # the depth behind the last step is left out in every chunk, and the last start
    counted = (f"flatten(zip_with(chunks, slice(starts, 1, size(chunks)), (c, d) -> slice({grown}, 1, size(c))))")
    starts = ("aggregate(effects, array(0), (a, e) -> "
              "array_append(a, greatest(e.fin, element_at(a, -1) + e.sum)))")
    effects = (f"transform(chunks, c -> named_struct('fin', aggregate(c, 0, {step}), "
               "'sum', aggregate(c, 0, (a, v) -> a + v)))")
    chunks = (f"transform(sequence(0, cast(floor((size(deltas) - 1) / {CHUNK}) as int)), "
              f"k -> slice(deltas, k * {CHUNK} + 1, {CHUNK}))")
    found = _let(chunks, "chunks", _let(effects, "effects", _let(starts, "starts", counted)))
    return _let(deltas, "deltas", f"if(size(deltas) = 0, cast(array() as array<int>), {found})")


def _places(flags: str) -> str:
    """1-based places of the true ones in an array of booleans."""
    return f"filter(transform({flags}, (f, i) -> if(f, i + 1, null)), i -> i is not null)"


def _between(after: str, before: str) -> str:
    """The pieces' text between one place and the next, for two arrays of places."""
    return (f"zip_with({after}, {before}, "
            "(s, e) -> array_join(slice(pieces, s + 1, greatest(e - s - 1, 0)), ''))")


_PIECES = f"regexp_extract_all(cell, r'{MARKERS_AND_RUNS}', 0)"
_DELTAS = "transform(pieces, x -> case x when '(' then 1 when ')' then -1 else 0 end)"
_CUTS = _places(f"zip_with(pieces, {running_depth(_DELTAS)}, (x, d) -> x = ',' and d = 0)")
NESTED_ITEMS = "cell -> " + _let(_PIECES, "pieces", _let(
    _CUTS, "cuts", "filter(" + _between("concat(array(0), cuts)", "concat(cuts, array(size(pieces) + 1))")
    + ", x -> x != '')"))

# an opening parenthesis is one only if some closing one is left for it, read from the end
_LEFT = "reverse(" + running_depth("transform(reverse(pieces), x -> case x when ')' then 1 when '(' then -1 else 0 end)") + ")"
_STEPS = (f"zip_with(pieces, {_LEFT}, (x, left_over) -> "
          "case when x = '(' and left_over > 0 then 1 when x = ')' then -1 else 0 end)")
_AT = f"zip_with({running_depth('steps')}, steps, (d, v) -> named_struct('depth', d, 'step', v))"
_OPENS = _places("transform(at, z -> z.depth = 0 and z.step = 1)")
_CLOSES = _places("transform(at, z -> z.depth = 1 and z.step = -1)")
_OUTSIDE = "zip_with(pieces, at, (x, z) -> if(z.depth = 0 and z.step < 1, x, null))"


def _of_notes(then: str) -> str:
    return "cell -> " + _let(_PIECES, "pieces", _let(_STEPS, "steps", _let(_AT, "at", then)))


NESTED_VALUE = _of_notes(f"trim(array_join({_OUTSIDE}, ''))")
NESTED_BODIES = _of_notes(f"array_join(transform({_between(_OPENS, _CLOSES)}, x -> trim(x)), ', ')")

# text up to the first parenthesis that closes none opened in it
_ENDS = _places(f"zip_with(pieces, {running_depth(_DELTAS)}, (x, d) -> x = ')' and d = 0)")
BEFORE_CLOSING = "cell -> " + _let(_PIECES, "pieces", "array_join(slice(pieces, 1, coalesce(get("
                                   + _ENDS + ", 0), size(pieces) + 1) - 1), '')")


def _apply(function: str, s: Column) -> Column:
    return F.get(F.call_function("transform", F.array(s), F.expr(function)), F.lit(0))


def _fields(**values: Column) -> Column:
    """A struct whose names hold inside lambdas."""
    return F.named_struct(*[x for k, v in values.items() for x in (F.lit(k), v)])


def items_outside_parens(c) -> Column:
    """Comma-separated items as an array; commas inside parentheses, nested ones too, do not split.

    A parenthesis that is never closed reaches to the end; one that closes nothing is text.
    """
    s = _c(c)
    plain = F.regexp_extract_all(s, F.lit(ITEM_OUTSIDE_PARENS), 0)
    # most cells have no parenthesis and need no pattern
    items = (F.when(~s.contains("("), F.array_remove(F.split(s, ","), ""))
             .when(s.rlike(NESTED), _apply(NESTED_ITEMS, s)).otherwise(plain))
    return F.transform(items, lambda x: F.trim(x))


def split_items(c, sep: str = ",") -> Column:
    """Items of a cell: outside parentheses for a comma, else split at the literal ``sep``."""
    return items_outside_parens(c) if sep == "," else F.split(_c(c), r"\Q" + sep + r"\E")


def _plain_value(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, PAREN_NOTE, ""))


def _plain_note(s: Column) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(s, F.lit(PAREN_BODY), 1), lambda x: F.trim(x)), ", ")


def split_note(c) -> Column:
    """struct(value, note): value without parentheticals, their bodies joined by ", " ('' if none).

    A note ends where its own parenthesis closes; notes inside it are part of
    its body. Parentheses without a partner are text.
    """
    s = _c(c)
    # each field has its own condition, so one that isn't asked for costs nothing
    bare, nested = ~s.contains("("), s.rlike(NESTED)
    return _fields(value=F.when(bare, F.trim(s)).when(nested, _apply(NESTED_VALUE, s)).otherwise(_plain_value(s)),
                   note=F.when(bare, F.lit("")).when(nested, _apply(NESTED_BODIES, s)).otherwise(_plain_note(s)))


def noted_items(c) -> Column:
    """The items outside parentheses as an array of struct(value, note), each pair once, without empty values.

    What form a cell has is asked once, not for each field of each item: a cell without
    parentheses has no notes, and one without nested ones only items without such.
    """
    s = _c(c)

    def pairs(items: Column, of) -> Column:
        return F.array_distinct(F.filter(F.transform(items, of), lambda p: p["value"] != ""))

    def plain(x: Column) -> Column:
        # mostly there is one note, and it ends the item
        head, rest = F.substring_index(x, "(", 1), F.substring_index(x, "(", -1)
        return (F.when(~x.contains("("), _fields(value=F.trim(x), note=F.lit("")))
                .when(x.rlike(ONE_NOTE), _fields(value=F.trim(head), note=F.trim(F.substring_index(rest, ")", 1))))
                .otherwise(_fields(value=_plain_value(x), note=_plain_note(x))))

    bare = F.transform(F.filter(F.array_distinct(F.transform(F.split(s, ","), lambda x: F.trim(x))), lambda x: x != ""),
                       lambda x: _fields(value=x, note=F.lit("")))
    return (F.when(~s.contains("("), bare)
            .when(s.rlike(NESTED), pairs(items_outside_parens(s), split_note))
            .otherwise(pairs(F.transform(F.regexp_extract_all(s, F.lit(ITEM_OUTSIDE_PARENS), 0), lambda x: F.trim(x)), plain)))


def clause_pattern(words=CLAUSE_WORDS) -> str:
    return r"(?s)\b(?:" + "|".join(words) + r")\b.*$"


def cut_clause(c, words=CLAUSE_WORDS) -> Column:
    """struct(value, clause): text before the first whole clause word and the clause itself.

    Word boundaries keep "without" whole. A trailing comma left on the value is removed.
    """
    s = _c(c)
    pat = clause_pattern(words)
    clause = F.regexp_extract(s, pat, 0)
    value = F.trim(F.regexp_replace(F.trim(F.regexp_replace(s, pat, "")), r"\s*,$", ""))
    return F.struct(value.alias("value"), clause.alias("clause"))


def descriptors_after(c, marker: str = TEMPERATURE_UNIT, default: str = MISSING,
                      words=CLAUSE_WORDS) -> Column:
    """struct(items array, clause) for cells like "17 degrees, foggy, mild with showers".

    The first measure before the marker is taken out; the text is cut at the
    first clause word and the rest split on commas. No item -> [default].
    The same parser serves the vocabulary and the bridge.
    """
    s = F.coalesce(_c(c), F.lit(""))
    after = F.regexp_replace(s, r"(?s)^(.*?)" + MEASURE.replace("(" + WHOLE + ")", WHOLE) + marker, "$1")
    pat = clause_pattern(words)
    clause = F.regexp_extract(after, pat, 0)
    body = F.regexp_replace(after, pat, "")
    items = F.filter(F.transform(F.split(body, ","), lambda x: F.trim(x)), lambda x: x != "")
    items = F.when(F.size(items) == 0, F.array(F.lit(default))).otherwise(items)
    return F.struct(items.alias("items"), clause.alias("clause"))


def split_hier_id(c, sep: str = ".", type_: str = "bigint") -> Column:
    """struct(parent, child) from "13.1"; a missing part -> NULL."""
    parts = F.split(_c(c).cast("string"), re.escape(sep))
    return F.struct(F.get(parts, 0).try_cast(type_).alias("parent"),
                    F.get(parts, 1).try_cast(type_).alias("child"))


def strip_parens(c) -> Column:
    """Name without parenthetical notes."""
    s = _c(c)
    return F.when(s.rlike(NESTED), _apply(NESTED_VALUE, s)).otherwise(F.trim(F.regexp_replace(s, PAREN_NOTE, "")))


def _before_closing(s: Column) -> Column:
    """Text up to the first parenthesis that closes none opened in it."""
    return (F.when(~s.contains(")"), s).when(s.rlike(r"^[^()]*\)"), F.substring_index(s, ")", 1))
            .otherwise(_apply(BEFORE_CLOSING, s)))


def section_name(c, marker: str = "section") -> Column:
    """Section label from "Park (Section North of the Mill) East" -> "North Of The Mill".

    Text after the first case-insensitive marker up to the parenthesis that
    closes the one it stands in (else to the end), initcap'ed; NULL when the marker is absent.
    """
    low = F.lower(_c(c))
    rest = F.substr(low, F.locate(marker, low) + len(marker))
    return F.when(low.contains(marker), F.initcap(F.trim(_before_closing(F.trim(rest)))))
