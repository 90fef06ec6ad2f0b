"""How the survey tables are numbered and looked up: no shuffle for small vocabularies, no row finds its key again."""

import fixtures
import pytest
from pyspark.sql import functions as F

from tidyspark.functions import parse as P
from tidyspark.functions import text as X
from tidyspark.operators import keys
from tidyspark.plans import pipeline, survey
from tidyspark.sources.headers import normalize_headers


def _sightings(spark, n, same=1):
    """n sightings; ``same`` of them at a time agree in the fact's columns and differ in the cells of the bridges."""
    k = (F.col("id") / same).cast("long").cast("string")
    cells = {"SquirrelID": F.concat(F.lit("S-"), k), "Park ID": F.lit("1"), "Primary Fur Color": F.lit("Russet"),
             "Highlights in Fur Color": F.lit("Amber, Cream"),
             "Location": F.when(F.col("id") % 2 == 0, "Low Wall").otherwise("Up High (roof, gutter)"),
             "Activities": F.concat(F.lit("Digging, Digging, Napping ("), F.col("id").cast("string"), F.lit(")")),
             "Interactions with Humans": F.lit("Flees"), "Squirrel Latitude (DD.DDDDDD)": F.lit("51.5")}
    df = spark.range(0, n, 1, 4)
    return normalize_headers(df.select(*[cells.get(h, F.lit(None).cast("string")).alias(h)
                                         for h in fixtures.SIGHTING_HEADERS]))


def _plans(monkeypatch):
    plans = []

    def note(df, label="stage", of=survey.materialize):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return of(df, label)
    monkeypatch.setattr(survey, "materialize", note)
    monkeypatch.setattr(keys, "_materialize", note)
    return plans


@pytest.mark.parametrize("table", ["squirrellocations", "squirrelhumaninteractions", "squirrelhighlights",
                                   "squirrelactivities"])
def test_bridges_of_sightings_join_nothing_by_a_shuffle(spark, monkeypatch, table):
    plans = _plans(monkeypatch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = survey.normalize_survey(spark, None, _sightings(spark, 40), only={table})
        assert t[table].count() == 40 * {"squirrelhighlights": 2, "squirrelactivities": 2}.get(table, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for _, p in plans)
    numbered = [p for label, p in plans if label == "key-in-runs"]
    assert len(numbered) == 1 and "Exchange hash" not in numbered[0] and "Exchange range" not in numbered[0]


@pytest.mark.parametrize("same", [1, 3])
def test_bridge_keys_follow_the_rows(spark, same):
    """Also where rows with one natural key have different cells."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")      # a file is read in pieces
    try:
        t = survey.normalize_survey(spark, None, _sightings(spark, 300, same), only={"squirrelactivities", "squirrellocations"})
        facts = {r["SquirrelID"]: r["SquirrelDataID"] for r in t["squirrels"].collect()}
        names = {r["ActivityName"]: r["ActivityID"] for r in t["activities"].collect()}
        bridge = sorted(tuple(r) for r in t["squirrelactivities"].select(
            "SquirrelActivityID", "SquirrelDataID", "ActivityID", "SquirrelActivityObs").collect())
        places = t["squirrellocations"].collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [facts[k] for k in sorted(facts)] == list(range(1, 300 // same + 1))
    expected = sorted({(facts[f"S-{i // same}"], names[a], note) for i in range(300)
                       for a, note in (("Digging", ""), ("Napping", str(i)))})
    assert bridge == [(i + 1, *x) for i, x in enumerate(expected)]
    assert sorted(r["SquirrelLocationID"] for r in places) == list(range(1, len(places) + 1))


def test_cells_are_parsed_once_per_distinct_cell(spark):
    plan = survey._items(_sightings(spark, 9), ["Location"], "LocationName")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")          # the grouping lies below


def test_cleaning_equals_the_plain_replacement(spark):
    texts = ["a\nb\n", "a!b", "!!", "a!", "!a", "", None, "é\U0001F600x", "ok\n!", "\n", "(a), b: #1 - x-", "a\x0bb", "12<·3"]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    for pattern, put in [(X.KEEP_TEXT, ""), (X.KEEP_COLOR, ""), (X.KEEP_LIST, " "), (X.KEEP_RANGE, ","), ("[^a]+", "-"), ("b", "$0")]:
        got = df.select(X.replace_chars("s", pattern, put).alias("x"), F.regexp_replace("s", pattern, put).alias("y"))
        assert all(r.x == r.y for r in got.collect())


def test_cells_without_parentheses(spark):
    cells = ["a,b", ",a,,b ,", "", " ", None, "a)b,c", "a (x, y),b", "a (b (c), d), e", "(", "a, ,b"]
    df = spark.createDataFrame([(x,) for x in cells], "s string")
    got = df.select(P.items_outside_parens("s").alias("i"), P.split_note("s")["value"].alias("v"),
                    P.split_note("s")["note"].alias("n")).collect()
    assert [r.i for r in got] == [["a", "b"], ["a", "b"], [], [""], None, ["a)b", "c"], ["a (x, y)", "b"],
                                  ["a (b (c), d)", "e"], ["("], ["a", "", "b"]]
    assert [(r.v, r.n) for r in got] == [("a,b", ""), (",a,,b ,", ""), ("", ""), ("", ""), (None, None), ("a)b,c", ""),
                                         ("a ,b", "x, y"), ("a , e", "b (c), d"), ("(", ""), ("a, ,b", "")]


def test_only_the_columns_of_the_wanted_tables_are_staged(spark, monkeypatch):
    staged = {}

    def note(df, label="stage", of=survey.materialize):
        staged[label] = set(df.columns)
        return of(df, label)
    monkeypatch.setattr(survey, "materialize", note)
    visits, sightings = fixtures.visits_df(spark), _sightings(spark, 9)
    t = survey.normalize_survey(spark, normalize_headers(visits), sightings, only={"parks", "squirrelactivities"})
    assert staged["survey-visits"] == {"AreaName", "AreaID", "ParkName", "ParkID"}
    assert not staged["survey-sightings"] & {"Location", "InteractionswithHumans"}
    whole = survey.normalize_survey(spark, normalize_headers(visits), sightings, only={"parks", "squirrelactivities", "locations"})
    for name in ("parks", "squirrelactivities"):
        assert sorted(map(str, t[name].collect())) == sorted(map(str, whole[name].collect()))


def test_heights_and_times_are_parsed_once(spark):
    plan = survey.stage_sightings(_sightings(spark, 9))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
    row = spark.createDataFrame([("x",)], "s string")
    plan = row.select(P.minutes_between("s", "s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 2

    cells = [("10-20", 10, 20), ("<30", 0, 30), (">30", 30, None), ("none", None, None), (None, None, None), ("", None, None),
             ("<5 >9", 0, 9), ("99999999999", None, None)]
    df = spark.createDataFrame([(c,) for c, *_ in cells], "s string").select(P.parse_range("s").alias("r"))
    assert [tuple(r.r) for r in df.collect()] == [tuple(x) for _, *x in cells]
    times = [("23:50:00", "00:10:30", 20), ("00:10:30", "23:50:00", 1419), ("10:00:00", "10:00:00", 0), ("10:00:00", None, None),
             ("x", "10:00:00", None)]
    df = spark.createDataFrame([t[:2] for t in times], "a string, b string")
    assert [r[0] for r in df.select(P.minutes_between("a", "b")).collect()] == [t[2] for t in times]


def test_rows_of_few_pieces_are_dealt_out(spark):
    n = spark.sparkContext.defaultParallelism
    few, many = spark.range(0, 1000, 1, 1), spark.range(0, 1000, 1, n + 3)
    assert pipeline._spread(few).rdd.getNumPartitions() == n and pipeline._spread(many).rdd.getNumPartitions() == n + 3
    assert sorted(r.id for r in pipeline._spread(few).collect()) == list(range(1000))


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    """A file of one row group may be cut into many pieces, of which one has all the rows."""
    n, path = spark.sparkContext.defaultParallelism, str(tmp_path / "rows")
    rows = spark.range(0, 20000, 1, 1).select("id", F.lit(None).cast("long").alias("none"))
    rows.write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // (2 * n)))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = spark.read.parquet(path)
        assert read.rdd.getNumPartitions() >= n
        spread = pipeline._spread(read)
        counts = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
        assert spread.columns == read.columns and len(counts) == n and max(counts) < 1.25 * 20000 / n
        assert sorted(tuple(r) for r in spread.collect()) == [(i, None) for i in range(20000)]
        # no rows need no dealing
        assert pipeline._spread(read.where("id < 0")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_many_rows_are_dealt_into_bounded_pieces(spark, monkeypatch):
    n = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(pipeline, "PIECE_ROWS", 100)
    spread = pipeline._spread(spark.range(0, 250 * n, 1, 1))
    assert spread.rdd.getNumPartitions() == 3 * n and spread.distinct().count() == 250 * n
