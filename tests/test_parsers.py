"""Parsers and cleaners on hand-made cells with expected values worked out by hand."""

import random
import re

from pyspark.sql import functions as F

from tidyspark.functions import parse as P
from tidyspark.functions import text as X
from tidyspark.sources.headers import normalize_headers


def _one(spark, value, expr, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_and_default(spark):
    assert _one(spark, '  "Lovely" - Kim!  ', X.clean("s")) == "Lovely  Kim"
    assert _one(spark, "", X.missing_to("s")) == "ND"
    assert _one(spark, None, X.missing_to("s")) == "ND"
    assert _one(spark, "a\x0bb", X.clean("s")) == "ab"        # vertical tab is not kept


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], ["Total Time (in minutes, if available)", "Area ID"])
    assert normalize_headers(df).columns == ["TotalTimeinminutesifavailable", "AreaID"]
    clash = spark.createDataFrame([(1, 2)], ["A B", "AB"])
    try:
        normalize_headers(clash)
        raise AssertionError("expected a collision error")
    except ValueError:
        pass


def test_dates_and_times(spark):
    import datetime as dt
    assert _one(spark, "3/1/20", P.parse_date("s", "M/d/yy", 2049)) == dt.date(2020, 3, 1)
    assert _one(spark, "3/1/98", P.parse_date("s", "M/d/yy", 2049)) == dt.date(1998, 3, 1)
    assert _one(spark, "31/31/20", P.parse_date("s", "M/d/yy")) is None
    assert _one(spark, "3:14:00 PM", P.parse_time("s")) == "15:14:00"
    assert _one(spark, "25:00 XM", P.parse_time("s")) is None
    df = spark.createDataFrame([("", "23:50:00", "00:10:00"), ("45", "10:00:00", "10:30:00"),
                                (None, "10:00:00", "10:30:59")], "m string, a string, b string")
    got = [r[0] for r in df.select(P.fill_minutes("m", "a", "b")).collect()]
    assert got == [20, 45, 30]


def test_range_number_head_tail(spark):
    r = lambda v: tuple(_one(spark, v, P.parse_range("s")))
    assert r("10-20") == (10, 20)
    assert r("<30") == (0, 30)
    assert r(">30") == (30, None)
    assert r("8 or 10") == (8, 10)
    assert r("high") == (None, None)
    assert _one(spark, "21-odd degrees, but hazy", P.extract_number("s")) == 21
    assert _one(spark, "21odd degrees", P.extract_number("s")) == 21
    assert _one(spark, "gales 20-30 knots", P.extract_number("s")) is None
    assert _one(spark, "gales 20-30 knots", P.extract_number("s", fallback=True)) == 20
    assert tuple(_one(spark, "Little, near the gate, wet", P.split_head_tail("s"))) == \
        ("Little", "near the gate, wet")
    assert tuple(_one(spark, "None", P.split_head_tail("s"))) == ("None", "")


def test_lists_notes_clauses(spark):
    items = lambda v: _one(spark, v, P.items_outside_parens("s"))
    assert items("Geese, Foxes (2, one limping), Toads (9), Hens") == \
        ["Geese", "Foxes (2, one limping)", "Toads (9)", "Hens"]
    assert items("Foxes (2, still, Hens") == ["Foxes (2, still, Hens"]      # never closed
    assert items("a\nb, c") == ["a\nb", "c"] and items("") == [] and items(None) is None
    note = lambda v: tuple(_one(spark, v, P.split_note("s")))
    assert note("Foxes (2, one limping)") == ("Foxes", "2, one limping")
    assert note("Foxes (2) (russet)") == ("Foxes", "2, russet")
    assert note("Foxes (2, still") == ("Foxes (2, still", "") and note("Hens") == ("Hens", "")
    cut = lambda v: tuple(_one(spark, v, P.cut_clause("s")))
    assert cut("hazy, but mild") == ("hazy", "but mild")
    assert cut("hazy without rain") == ("hazy without rain", "")
    assert cut("hazy but\nmild\n") == ("hazy", "but\nmild\n")


def test_items_of_any_length(spark):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("x"), 1_000_000), F.lit(", y"),
                                        F.repeat(F.lit(" (a, b)"), 20_000)).alias("s"))
    got = df.select(F.explode(P.items_outside_parens("s")).alias("i")).select(F.length("i")).collect()
    assert [r[0] for r in got] == [1_000_000, 140_001]


def test_descriptors(spark):
    d = lambda v: tuple(_one(spark, v, P.descriptors_after("s")))
    assert d("17 degrees, foggy") == (["foggy"], "")
    assert d("17 degrees") == (["ND"], "")
    assert d("damp, dim") == (["damp", "dim"], "")
    assert d("21odd degrees, but hazy") == (["ND"], "but hazy")
    assert d("22.5 degrees, hazy, with two showers") == (["hazy"], "with two showers")
    assert d("17 degrees, foggy, then 9 degrees") == (["foggy", "then 9 degrees"], "")
    assert d("foggy, 17 degrees, dim") == (["foggy", "dim"], "")
    assert d(None) == (["ND"], "")


def test_decimals(spark):
    assert _one(spark, "22.5 degrees", P.extract_number("s")) == 22
    assert _one(spark, "12.5", P.fill_minutes("s", F.lit("10:00:00"), F.lit("11:00:00"))) == 12


def test_hier_id_and_sections(spark):
    assert tuple(_one(spark, "13.1", P.split_hier_id("s"))) == (13, 1)
    assert tuple(_one(spark, "13", P.split_hier_id("s"))) == (13, None)
    assert tuple(_one(spark, "9999999999.1", P.split_hier_id("s"))) == (9999999999, 1)
    assert _one(spark, "Canal Walk (Section North of the Lock)", P.section_name("s")) == \
        "North Of The Lock"
    assert _one(spark, "Walk (Section by the Section House)", P.section_name("s")) == "By The Section House"
    assert _one(spark, "Beacon Field", P.section_name("s")) is None
    assert _one(spark, "Canal Walk (Section X)", P.strip_parens("s")) == "Canal Walk"


def test_parsers_stay_in_jvm(spark):
    df = spark.createDataFrame([("17 degrees, foggy (x, y)",)], "s string")
    out = df.select(P.descriptors_after("s"), P.parse_range("s"), P.split_note("s"),
                    F.explode(P.items_outside_parens("s")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def _depth_items(text):
    """Items by walking over the letters."""
    out, depth, item = [], 0, ""
    for ch in text:
        if ch == "," and depth == 0:
            out.append(item)
            item = ""
            continue
        depth = max(0, depth + (ch == "(") - (ch == ")"))
        item += ch
    return [x.strip(" ") for x in [*out, item] if x]


def _depth_note(text):
    """Value and note with a stack of open parentheses."""
    stack, pairs = [], {}
    for i, ch in enumerate(text):
        if ch == "(":
            stack.append(i)
        elif ch == ")" and stack:
            pairs[stack.pop()] = i
    value, notes, i = "", [], 0
    while i < len(text):
        if i in pairs:
            notes.append(text[i + 1:pairs[i]].strip(" "))
            i = pairs[i]
        else:
            value += text[i]
        i += 1
    return value.strip(" "), ", ".join(notes)


def test_nested_and_unbalanced_parentheses(spark):
    rnd = random.Random(11)
    cells = ["Dogs (a (b), c), Cats", "Dogs (a (b))", "a (b, (c, d (e, f)) g), h) i, (j", "((a), b), c", "()(()), ,",
             "x (y (z", "x) y (z (w)) v"]
    cells += ["".join(rnd.choice(["(", ")", ",", "a", " b", "é"]) for _ in range(rnd.randint(1, 30))) for _ in range(400)]
    cells += ["".join(rnd.choice("((,))ab ") for _ in range(n)) for n in (255, 256, 257, 511, 2000)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, s string")
    got = df.select("i", P.items_outside_parens("s").alias("items"), P.split_note("s").alias("n"),
                    P.strip_parens("s").alias("stripped")).orderBy("i").collect()
    for r, c in zip(got, cells):
        if "(" not in c:
            assert r["items"] == _depth_items(c), c
        if re.search(P.NESTED, c):
            assert r["items"] == _depth_items(c) and tuple(r.n) == _depth_note(c), c
            assert r.stripped == _depth_note(c)[0]


def test_nested_cells_of_any_length(spark):
    df = spark.range(1).select(
        F.concat(F.lit("d (a (b), "), F.repeat(F.lit("x"), 1_000_000), F.lit("), y")).alias("long"),
        F.concat(F.lit("v (("), F.repeat(F.lit("a (b, c), "), 20_000), F.lit(")), w")).alias("notes"),
        F.concat(F.repeat(F.lit("i (n (m, o)), "), 20_000), F.lit("last")).alias("items"))
    long, notes, items = df.select(*[P.items_outside_parens(c) for c in df.columns]).first()
    assert [len(x) for x in long] == [1_000_011, 1] and [len(x) for x in notes] == [200_006, 1]
    assert len(items) == 20_001 and set(items[:-1]) == {"i (n (m, o))"}
    n = df.select(P.split_note("items")).first()[0]
    assert n.note == ", ".join(["n (m, o)"] * 20_000) and n.value.endswith("last")


def test_signs_cases_decimals_and_text_behind_sections(spark):
    number = lambda v, **kw: _one(spark, v, P.extract_number("s", **kw))
    assert number("-5 degrees") == -5 and number("43 Degrees") == 43 and number("40-45 degrees") == 45
    assert number("about +7.5 DEGREES", type_="double") == 7.5 and number("-0.5 degrees", type_="double") == -0.5
    assert number("gales -3", fallback=True) == -3 and number("x2-3", unit=None) == 2
    section = lambda v: _one(spark, v, P.section_name("s"))
    assert section("Park (Section A) North") == "A"
    assert section("Park (Section A (east (far)) end) North").lower() == "a (east (far)) end"
    assert section("Walk Section North") == "North" and section("Walk (Section )") == ""
    assert _one(spark, "Park (a (b) c) Hill", P.strip_parens("s")) == "Park  Hill"
