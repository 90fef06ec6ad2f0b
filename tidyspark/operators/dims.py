"""Vocabulary (dimension) tables from single-, multi-valued and several columns.

Each builder is ``select -> (explode) -> distinct -> dense_key``: the distinct is
a hash aggregation with map-side combine, so a value repeated in a third of all
rows collapses before the shuffle, and the keys are numbered without a
single-task sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyspark.functions.parse import section_name, split_hier_id, split_items, split_note
from tidyspark.functions.text import MISSING, missing_to
from tidyspark.operators.keys import dense_key


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vocabulary(values: DataFrame, name: str, key: str, start: int = 0,
               order_by=None, default: str | None = MISSING, **dense_opts) -> DataFrame:
    """(key, name) for the distinct values of the single column ``name``."""
    v = values.select(F.trim(F.col(name)).alias(name))
    if default is not None:
        v = v.select(missing_to(name, default).alias(name))
    v = v.where(F.col(name).isNotNull()).distinct()
    return dense_key(v, order_by or [name], key, start=start, unique=True, **dense_opts).select(key, name)


def dim_from_column(df: DataFrame, value, name: str, key: str, **opts) -> DataFrame:
    """One value per row: ``value`` is a column name or a cleaning expression."""
    return vocabulary(df.select(_c(value).alias(name)), name, key, **opts)


def dim_from_list(df: DataFrame, value, name: str, key: str, sep: str | None = ",",
                  strip_notes: bool = True, **opts) -> DataFrame:
    """Many values per cell.

    ``sep=","`` splits outside parentheses; notes in parentheses are removed
    when ``strip_notes``. Any other ``sep`` is taken literally.
    """
    return _dim_from_items(df, split_items(_c(value), sep), name, key, strip_notes, **opts)


def _dim_from_items(df: DataFrame, items: Column, name: str, key: str, strip_notes: bool,
                    **opts) -> DataFrame:
    ex = df.select(F.explode(items).alias(name))
    if strip_notes:
        ex = ex.select(split_note(name)["value"].alias(name))
    ex = ex.where(F.trim(F.col(name)) != "")
    return vocabulary(ex, name, key, default=None, **opts)


def dim_from_columns(df: DataFrame, values: list, name: str, key: str, sep: str | None = ",",
                     strip_notes: bool = True, **opts) -> DataFrame:
    """One shared vocabulary from several (multi-valued) columns."""
    none = F.array().cast("array<string>")
    items = F.concat(*[F.coalesce(split_items(_c(v), sep or ","), none) for v in values])
    return _dim_from_items(df, items, name, key, strip_notes, **opts)


def section_rows(df: DataFrame, id_col: str, name_col: str, marker: str = "section",
                 parent: str = "ParkID", child: str = "SectionID",
                 label: str = "ParkSectionName") -> DataFrame:
    """Distinct sections without keys."""
    hid = split_hier_id(id_col)
    return (df.where(F.lower(F.col(name_col)).contains(marker))
            .select(hid["parent"].alias(parent), hid["child"].alias(child),
                    section_name(name_col, marker).alias(label))
            .distinct())


def extract_sections(df: DataFrame, id_col: str, name_col: str, marker: str = "section",
                     key: str = "ParkSectionID", parent: str = "ParkID",
                     child: str = "SectionID", label: str = "ParkSectionName",
                     **opts) -> DataFrame:
    """Sections of hierarchical entities: ("13.1", "X (Section Above Y)") -> (13, 1, "Above Y").

    Natural key is (parent, child, label); keys ordered by it.
    """
    s = section_rows(df, id_col, name_col, marker, parent, child, label)
    return dense_key(s, [parent, child, label], key, unique=True, **opts).select(key, parent, child, label)

