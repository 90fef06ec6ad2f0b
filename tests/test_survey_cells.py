"""The cells' parsers of the survey: what a cell looks like is asked once, and results equal those of the single steps."""

import pytest
from pyspark.sql import functions as F

from tidyspark.functions import parse as P
from tidyspark.functions import text as X
from tidyspark.operators import facts
from tidyspark.plans import survey
from test_survey_scale import _sightings

CELLS = ["a,b", ",a,,b ,a", "", " ", None, "a)b,c", "a (x, y),b", "a (b (c), d), e, a (b (c), d)", "(", "a, ,b", "a (x),a(x), a ( x )",
         "a (x) b (y)", "(x) a", "a (x", "a (x), b (y", "a ()", "a (x\n)\n, b", "Up High (roof, gutter)", "(x)", "a (x) ,b ) c (y)", "a\n(x)"]


def _steps(value):
    pairs = F.transform(P.items_outside_parens(value), lambda x: F.struct(P.split_note(x)["value"].alias("value"),
                                                                          P.split_note(x)["note"].alias("note")))
    return F.array_distinct(F.filter(pairs, lambda p: p["value"] != ""))


def test_noted_items_equal_the_single_steps(spark):
    df = spark.createDataFrame([(x,) for x in CELLS], "s string")
    for cell, got, steps in df.select("s", facts.noted_items("s"), _steps("s")).collect():
        assert got == steps, cell


def test_items_are_not_asked_for_nested_notes_one_by_one(spark):
    plan = spark.createDataFrame([("a",)], "s string").select(facts.noted_items("s"))._jdf.queryExecution().optimizedPlan().toString()
    nested = P.NESTED
    # one question for the cell; the others stand in the branch of cells that have nested notes
    asked = plan.index(nested)
    assert "regexp_extract_all(" not in plan[:asked]


def test_heights_need_one_lambda(spark):
    plan = survey.stage_sightings(_sightings(spark, 9))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(") == 1


@pytest.mark.parametrize("cell,low,high", [("10-20", 10, 20), ("10.5-20.25", 10, 20), ("<30.5", 0, 30), (">30", 30, None), ("8 or 10", 8, 10),
                                           ("none", None, None), (None, None, None), ("", None, None), ("<5 >9", 0, 9), (".5", 5, 5),
                                           ("99999999999", None, None), ("99999999999 7", 7, 7), ("1.2.3", 1, 3)])
def test_staged_heights(spark, cell, low, high):
    s = _sightings(spark, 1).withColumn("AboveGroundHeightinFeet", F.lit(cell).cast("string"))
    row = survey.stage_sightings(s).select("MinHeightFeet", "MaxHeightFeet").first()
    assert tuple(row) == (low, high)


def test_kept_characters_are_written_out(spark):
    plan = spark.createDataFrame([("a",)], "s string").select(X.replace_chars("s", X.KEEP_TEXT))._jdf.queryExecution().optimizedPlan().toString()
    assert "a-z" not in plan and "A-Z" not in plan and "0-9" not in plan
    texts = ["".join(map(chr, range(1, 400))), "aZ09-_.é", "az", "{", "`", "@[", "/:"]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    for pattern in (X.KEEP_TEXT, X.KEEP_COLOR, X.KEEP_LIST, X.KEEP_RANGE):
        assert all(r.x == r.y for r in df.select(X.replace_chars("s", pattern, " ").alias("x"), F.regexp_replace("s", pattern, " ").alias("y")).collect())
