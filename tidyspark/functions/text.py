"""Text cleaning as built-in column expressions (no Python per row).

Every function returns a ``Column`` (or a DataFrame built with one
``withColumns``), so a whole cleaning stage is a single projection that stays
inside whole-stage codegen and runs on whole texts of any length.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the surveyed behaviour) -------------------------
# Sentinel written for a missing value.
MISSING = "ND"
# Characters kept in free text: letters, digits, white space and # ( ) , :
# White space is written out (space, tab, newline, carriage return, form feed)
# because Java's \s also matches vertical tab while RE2's does not.
KEEP_TEXT = r"[^a-zA-Z0-9 \t\n\r\f#(),:]"
# Characters kept in colour lists: letters, digits, white space, # and comma.
KEEP_COLOR = r"[^a-zA-Z0-9 \t\n\r\f#,]"
# Characters kept in multi-valued lists (other characters become a space):
# letters, digits, white space and # , / ? ( ) :
KEEP_LIST = r"[^a-zA-Z0-9 \t\n\r\f#,/?():]"
# Characters kept in a height / range cell (others become a comma): digits,
# white space and < >
KEEP_RANGE = r"[^0-9 \t\n\r\f<>]"
# Header characters removed by normalize_headers: space ( ) ,
HEADER_DROP = " (),"
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _spelled(kept: str) -> str:
    """A class's members with the ranges of ASCII letters and digits written out.

    The matcher looks up single characters in one table, but tests ranges one after the other.
    """
    return re.sub(r"a-z|A-Z|0-9", lambda r: "".join(map(chr, range(ord(r[0][0]), ord(r[0][2]) + 1))), kept)


def replace_chars(c, pattern: str, replacement: str = "") -> Column:
    """regexp_replace(c, pattern, replacement), quick where ``pattern`` is one negated class ``[^...]``.

    A search for a class starts anew at each character. Here one possessive run tells the texts
    that have only kept characters, and in the others it skips the kept ones before each other one.
    """
    s = _c(c)
    kept = re.fullmatch(r"\[\^([^\[\]&]+)\]", pattern)
    if kept is None or re.search(r"[\\$]", replacement):
        return F.regexp_replace(s, pattern, replacement)
    run, pattern = f"[{_spelled(kept.group(1))}]*+", f"[^{_spelled(kept.group(1))}]"
    return (F.when(s.rlike(rf"\A{run}\z"), s)
            .otherwise(F.regexp_replace(s, rf"\G({run}){pattern}", "$1" + replacement)))


def clean(c, pattern: str = KEEP_TEXT, replacement: str = "") -> Column:
    """trim(regexp_replace(c, pattern, replacement)); trim removes spaces only."""
    return F.trim(replace_chars(c, pattern, replacement))


def missing_to(c, default: str = MISSING) -> Column:
    """NULL or empty string -> ``default``."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default))


def clean_text(df: DataFrame, spec: dict) -> DataFrame:
    """Clean several columns in one projection.

    ``spec`` maps a column name to a pattern, to ``(pattern, replacement)`` or
    to ``(pattern, replacement, default)``; with a default, NULL/empty results
    become that sentinel.
    """
    exprs = {}
    for name, rule in spec.items():
        if isinstance(rule, str):
            rule = (rule,)
        pattern = rule[0]
        replacement = rule[1] if len(rule) > 1 else ""
        e = clean(name, pattern, replacement)
        if len(rule) > 2 and rule[2] is not None:
            e = missing_to(e, rule[2])
        exprs[name] = e
    return df.withColumns(exprs)


def fill_default(df: DataFrame, cols, default: str = MISSING) -> DataFrame:
    """NULL or empty -> default for every column in ``cols`` (one projection)."""
    if isinstance(cols, str):
        cols = [cols]
    return df.withColumns({c: missing_to(c, default) for c in cols})


def strip_quotes(c) -> Column:
    """Remove double quotes (a quoted remark such as '"Lovely" - Kim')."""
    return F.trim(F.replace(_c(c), F.lit('"'), F.lit("")))
