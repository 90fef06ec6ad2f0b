"""The survey pipeline on the hand-made fixture: tables, reports, audit, idempotent store."""

import fixtures
from pyspark.sql import functions as F

from tidyspark.plans.survey import normalize_survey, survey_audit, survey_reports
from tidyspark.sources.headers import normalize_headers
from tidyspark.sources.tables import read_csv


def _inputs(spark):
    return (normalize_headers(fixtures.visits_df(spark)),
            normalize_headers(fixtures.sightings_df(spark)))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_vocabularies_and_facts(spark):
    t = normalize_survey(spark, *_inputs(spark))
    assert _rows(t["areas"]) == [(1, "H", "HILLTOP"), (2, "R", "RIVERBANK")]
    assert _rows(t["parks"]) == [(1, 2, "Orchard Green"), (2, 2, "Mill Meadow"), (3, 2, "Canal Walk"),
                                 (4, 1, "Beacon Field")]
    assert _rows(t["parksections"]) == [(1, 3, 1, "North Of The Lock"), (2, 3, 2, "By The Tow Path")]
    assert [r[1] for r in sorted(t["animals"].collect())] == \
        ["Foxes", "Geese", "Hens", "ND", "Otter", "Toads"]
    assert [r[1] for r in sorted(t["weathers"].collect())] == ["ND", "damp", "dim", "foggy", "hazy"]
    assert [r[1] for r in sorted(t["activities"].collect())] == \
        ["Digging", "Leaping", "Napping", "Sparring", "Sprinting"]
    ps = {r["ParkStatusID"]: r for r in t["parkstatus"].collect()}
    assert [ps[i]["TotalTime"] for i in range(1, 6)] == [40, 45, 25, 25, 40]
    assert [ps[i]["TemperatureDegrees"] for i in range(1, 6)] == [17, None, 21, 22, None]
    animals = _rows(t["parkstatusanimals"].where(F.col("ParkStatusAnimalObs") != ""))
    assert [r[3] for r in animals] == ["2, one limping", "9"]
    assert t["squirrels"].count() == 5       # the duplicated sighting row is one squirrel row
    # every highlight colour is kept, not only the first
    colors = {r["ColorID"]: r["ColorName"] for r in t["colors"].collect()}
    ids = {r["SquirrelDataID"]: r["SquirrelID"] for r in t["squirrels"].collect()}
    high = sorted((ids[r["SquirrelDataID"]], colors[r["ColorID"]]) for r in t["squirrelhighlights"].collect())
    assert high == [("Q-7", "Amber"), ("Q-7", "Cream"), ("Q-8", "ND"), ("R-2", "Russet"), ("T-1", "ND"),
                    ("T-2", "Cream")]


def test_reports(spark):
    r = survey_reports(normalize_survey(spark, *_inputs(spark)))
    assert [tuple(x) for x in r["query_1"].collect()] == \
        [(1, "Orchard Green", 2), (2, "Mill Meadow", 1), (3, "Canal Walk", 2)]
    assert [tuple(x) for x in r["query_2"].collect()] == [(2, "RIVERBANK", 5)]
    assert [tuple(x) for x in r["query_4"].collect()] == \
        [(1, "Digging"), (2, "Leaping"), (3, "Napping"), (4, "Sparring"), (5, "Sprinting")]
    q3 = {(a, b): c for a, b, c in r["query_3"].collect()}
    assert q3[("Canal Walk", "Geese")] == 2 and q3[("Beacon Field", "ND")] == 1
    assert [tuple(x) for x in r["query_5"].collect()] == [
        (1, "Orchard Green", "Russet", 1), (1, "Orchard Green", "Slate", 1), (2, "Mill Meadow", "Amber", 1),
        (3, "Canal Walk", "Russet", 2)]


def test_only_the_tables_asked_for(spark):
    t = normalize_survey(spark, *_inputs(spark), only={"squirrelactivities"})
    assert set(t) == {"colors", "activities", "squirrels", "squirrelactivities"}


def test_second_name_of_a_park_is_reported(spark):
    v, s = _inputs(spark)
    other = v.where("ParkID = '2'").withColumn("ParkName", F.lit("Old Mill Meadow"))
    t = normalize_survey(spark, v.unionByName(other), s)
    bad = [tuple(r) for r in survey_audit(t).where("violations > 0").collect()]
    assert bad == [("parkvariants", "primary_key_duplicates", "ParkID", 2)]
    assert t["parkvariants"].where("ParkID = 2").count() == 2


def test_audit_clean_and_broken(spark):
    t = normalize_survey(spark, *_inputs(spark))
    assert survey_audit(t).where("violations > 0").count() == 0
    broken = dict(t, parks=t["parks"].where("ParkID <> 3"))
    bad = {(r[0], r[1], r[2]): r[3] for r in survey_audit(broken).where("violations > 0").collect()}
    assert bad[("squirrels", "foreign_key_orphans", "ParkID")] == 2
    assert bad[("parkstatus", "foreign_key_orphans", "ParkID")] == 2


def test_store_merge_is_idempotent(spark, tmp_store):
    v, s = _inputs(spark)
    first = {k: _rows(df) for k, df in normalize_survey(spark, v, s, store=tmp_store).items()}
    second = {k: _rows(df) for k, df in normalize_survey(spark, v, s, store=tmp_store).items()}
    assert first == second
    fresh = {k: _rows(df) for k, df in normalize_survey(spark, v, s).items()}
    assert first == fresh


def test_store_merge_adds_only_new_rows(spark, tmp_store):
    v, s = _inputs(spark)
    part = normalize_survey(spark, v.where("ParkID <> '2'"), s, store=tmp_store)
    before = {r[1]: r[0] for r in part["animals"].collect()}
    full = normalize_survey(spark, v, s, store=tmp_store)
    after = {r[1]: r[0] for r in full["animals"].collect()}
    assert all(after[n] == k for n, k in before.items())      # known keys never change
    assert after["Toads"] == max(before.values()) + 1          # new value numbered after max


def test_csv_source_roundtrip(spark, tmp_path):
    path = str(tmp_path / "visits")
    fixtures.visits_df(spark).write.option("header", True).csv(path)
    df = read_csv(spark, path)
    assert df.columns[7] == "TotalTimeinminutesifavailable"
    assert df.count() == len(fixtures.VISITS)


def test_report_sql_over_views_matches_operator(spark):
    from tidyspark.plans.survey import register_views
    t = normalize_survey(spark, *_inputs(spark))
    register_views(t)
    sql = """
        SELECT q.ParkID, p.ParkName, COUNT(*) AS qty_squirrel
        FROM (SELECT ParkID, SquirrelID FROM squirrels GROUP BY ParkID, SquirrelID) q
        LEFT JOIN parks p ON q.ParkID = p.ParkID
        GROUP BY q.ParkID, p.ParkName"""
    assert _rows(spark.sql(sql)) == _rows(survey_reports(t)["query_1"])


def test_run_pipeline_writes_reports(spark, tmp_path):
    from tidyspark.plans.pipeline import run_pipeline
    out = run_pipeline(spark, fixtures.visits_df(spark), fixtures.sightings_df(spark),
                       report_dir=str(tmp_path / "output"))
    back = spark.read.option("header", True).csv(str(tmp_path / "output" / "query_4"))
    assert back.columns == ["Top", "TopActivities"]
    assert sorted(tuple(r) for r in back.collect()) == \
        sorted((str(a), b) for a, b in out["query_4"].collect())


def test_command_line_run_is_idempotent(spark, tmp_path):
    from tidyspark.__main__ import main
    v, s = str(tmp_path / "visits.csv"), str(tmp_path / "sightings.csv")
    fixtures.visits_df(spark).coalesce(1).write.option("header", True).csv(v)
    fixtures.sightings_df(spark).coalesce(1).write.option("header", True).csv(s)
    args = ["--visits", v, "--sightings", s, "--store", str(tmp_path / "store"),
            "--reports", str(tmp_path / "output")]
    assert main(args) == 0
    first = _rows(spark.read.parquet(str(tmp_path / "store" / "squirrels")))
    assert main(args) == 0
    assert _rows(spark.read.parquet(str(tmp_path / "store" / "squirrels"))) == first
    q1 = spark.read.option("header", True).csv(str(tmp_path / "output" / "query_1"))
    assert q1.columns == ["ParkID", "ParkName", "qty_squirrel"] and q1.count() == 3


def test_section_without_number_links_by_name(spark):
    extra = spark.createDataFrame(
        [("HILLTOP", "H", "Quarry Wood (section near Cave)", "5", "9/16/21", "1:00:00 PM",
          "1:30:00 PM", "30", "Empty", "Geese", "Nothing", "19 degrees, foggy")],
        fixtures.visits_df(spark).schema)
    v = normalize_headers(fixtures.visits_df(spark).unionByName(extra))
    t = normalize_survey(spark, v, normalize_headers(fixtures.sightings_df(spark)))
    sec = {r["ParkSectionName"]: r for r in t["parksections"].collect()}
    assert sec["Near Cave"]["ParkID"] == 5 and sec["Near Cave"]["SectionID"] is None
    row = t["parkstatus"].where("ParkID = 5").first()
    assert row["ParkSectionID"] == sec["Near Cave"]["ParkSectionID"]
