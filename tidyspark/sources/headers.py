"""Header normalisation: "Total Time (in minutes, if available)" -> "TotalTimeinminutesifavailable"."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame

from tidyspark.functions.text import HEADER_DROP


def normalized_name(name: str, drop: str = HEADER_DROP) -> str:
    return "".join(ch for ch in name if ch not in drop)


def normalize_headers(df: DataFrame, drop: str = HEADER_DROP) -> DataFrame:
    """Delete the ``drop`` characters from every column name (one ``toDF``).

    Two raw names that normalise to the same name are an error, not a silent
    overwrite.
    """
    names = [normalized_name(c, drop) for c in df.columns]
    clashes = [n for n, k in Counter(names).items() if k > 1]
    if clashes:
        raise ValueError(f"header normalisation makes duplicate columns: {clashes}")
    return df.toDF(*names)
