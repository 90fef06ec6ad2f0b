"""The park-visit / sighting survey normalised into keyed tables, then reported.

Inputs are the two wide survey tables after header normalisation:

* visits: AreaName, AreaID, ParkName, ParkID ("13.1" = park 13, section 1),
  Date, StartTime, EndTime, TotalTimeinminutesifavailable, ParkConditions,
  OtherAnimalSightings, Litter, Temperature&Weather
* sightings: SquirrelID, ParkID, PrimaryFurColor, HighlightsinFurColor,
  ColorNotes, AboveGroundHeightinFeet, Location, SpecificLocation, Activities,
  InteractionswithHumans, OtherNotesorObservations, SquirrelLatitudeDD.DDDDDD,
  SquirrelLongitude-DD.DDDDDD

``normalize_survey`` builds the tables in foreign-key order. With ``store``
every table is merged into ``store/<table>`` (append-only, NULL-safe natural
keys) and later tables use the stored keys, so a second run with the same
input changes nothing. Fact keys are assigned once; bridges join back to the
fact on its natural key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.functions import parse as P
from tidyspark.functions import text as X
from tidyspark.operators import dims, facts, reports
from tidyspark.operators.audit import audit
from tidyspark.operators.keys import dense_key, key_in_runs
from tidyspark.session import materialize
from tidyspark.sources.tables import merge_into_path
from tidyspark.specs import TableSpec, fk

TW = "Temperature&Weather"
LAT = "SquirrelLatitudeDD.DDDDDD"
LON = "SquirrelLongitude-DD.DDDDDD"
VOCABULARY_ROWS = 200_000        # vocabularies, areas and sections up to this size are broadcast


# -- staging ------------------------------------------------------------------------

def stage_visits(visits: DataFrame, date_fmt: str = "M/d/yy", pivot_year: int | None = 2049,
                 time_fmt: str = "h:mm:ss a") -> DataFrame:
    text = {c: (X.KEEP_TEXT, "", X.MISSING) for c in
            ["AreaName", "AreaID", "ParkName", "ParkConditions", "OtherAnimalSightings",
             "Litter", TW]}
    # numbers are read before cleaning, which drops decimal points
    numbers = {"TemperatureDegrees": P.extract_number(TW),
               "StatedMinutes": F.col("TotalTimeinminutesifavailable").cast("string")}
    v = X.clean_text(visits.withColumn("ParkID", F.col("ParkID").cast("string")).withColumns(numbers), text)
    v = v.withColumns({
        "Date": P.parse_date(F.trim("Date"), date_fmt, pivot_year),
        "StartTime": P.parse_time(F.trim("StartTime"), time_fmt),
        "EndTime": P.parse_time(F.trim("EndTime"), time_fmt),
    })
    return v.withColumn("TotalTimeinminutesifavailable",
                        P.fill_minutes("StatedMinutes", "StartTime", "EndTime")).drop("StatedMinutes")


def stage_sightings(sightings: DataFrame) -> DataFrame:
    spec = {
        "PrimaryFurColor": (X.KEEP_COLOR, "", X.MISSING),
        "HighlightsinFurColor": (X.KEEP_COLOR, "", X.MISSING),
        "ColorNotes": (X.KEEP_TEXT, "", X.MISSING),
        "Location": (X.KEEP_TEXT, "", X.MISSING),
        "SpecificLocation": (X.KEEP_TEXT, "", X.MISSING),
        "Activities": (X.KEEP_LIST, " ", X.MISSING),
        "InteractionswithHumans": (X.KEEP_LIST, " ", X.MISSING),
        "OtherNotesorObservations": (X.KEEP_LIST, " ", X.MISSING),
    }
    s = X.clean_text(sightings.withColumnsRenamed({LAT: "SquirrelLatitude",
                                                   LON: "SquirrelLongitude"}), spec)
    height = F.col("AboveGroundHeightinFeet").cast("string")
    height = F.when(height.contains("."), F.regexp_replace(height, r"(\d)\.\d+", "$1")).otherwise(height)
    s = (s.withColumn("__height", height).withColumn("__height", X.replace_chars("__height", X.KEEP_RANGE, ","))
         .withColumn("__numbers", F.get(F.transform(F.array("__height"), P.range_numbers), 0))
         .withColumn("__range", P.range_of("__height", "__numbers")))
    return s.withColumns({
        "ParkID": P.split_hier_id("ParkID")["parent"],
        "MinHeightFeet": F.col("__range.min"), "MaxHeightFeet": F.col("__range.max"),
        "SquirrelLatitude": F.col("SquirrelLatitude").try_cast("double"),
        "SquirrelLongitude": F.col("SquirrelLongitude").try_cast("double"),
    }).drop("__height", "__numbers", "__range")


# -- keyed tables -----------------------------------------------------------------------

class _Keyer:
    """Fresh build (dense keys from 1) or merge into stored tables."""

    def __init__(self, spark: SparkSession, store: str | None):
        self.spark, self.store = spark, store

    def __call__(self, name: str, rows: DataFrame, natural_key, key: str, order_by=None,
                 columns=None) -> DataFrame:
        natural_key = list(natural_key)
        if self.store is None:
            # numbering leaves the rows written, in order: later passes read that file
            out = dense_key(rows.distinct(), order_by or natural_key, key, unique=True)
        else:
            out = merge_into_path(self.spark, f"{self.store.rstrip('/')}/{name}", rows,
                                  natural_key, key, order_by, schema=SCHEMAS[name])
        return out.select(*(columns or [key, *rows.columns]))


def _join_back(rows: DataFrame, table: DataFrame, natural_key, key: str, max_rows: int | None = None) -> DataFrame:
    """Attach the stored key to staged rows by NULL-safe match on the natural key.

    Rows meet on one hash of the natural key; its columns are compared after that.
    A table of at most ``max_rows`` rows is broadcast.
    """
    t = table.select(key, F.xxhash64(*natural_key).alias("__t_hash"),
                     *[F.col(c).alias(f"__t_{c}") for c in natural_key])
    t = facts.checked_broadcast(t, max_rows)
    cond = F.xxhash64(*[rows[c] for c in natural_key]) == t["__t_hash"]
    for c in natural_key:
        cond = cond & rows[c].eqNullSafe(t[f"__t_{c}"])
    return rows.join(t, cond, "left").drop("__t_hash", *[f"__t_{c}" for c in natural_key])


RUN = "__run"


def _one_row_a_key(rows: DataFrame, natural_key) -> bool:
    """Whether no two of these different rows have the same natural key; its hashes are compared first."""
    hashed = rows.select(*natural_key, F.xxhash64(*natural_key).alias("__hash"))
    twice = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__hash")
    if twice.isEmpty():
        return True
    return (hashed.join(twice, "__hash", "left_semi").groupBy(*natural_key).agg(F.count(F.lit(1)).alias("__n"))
            .where("__n > 1").isEmpty())


def _fact_with_cells(key: _Keyer, name: str, rows: DataFrame, natural_key, id_: str, cells, cut):
    """The keyed fact, and its key with the ``cells`` that the bridges are made of.

    The cells travel with the rows while these are numbered. Where each natural key has
    one set of cells, as a rule, the numbered rows are the fact and no row has to find its key again
    (the frame then has a column RUN); else, and for a stored fact, the rows are joined back.
    """
    if key.store is None and cells:
        numbered = dense_key(rows.select(*natural_key, *cells).distinct(), natural_key, id_, unique=True, run=RUN)
        if _one_row_a_key(numbered, natural_key):
            return numbered.select(id_, *natural_key), numbered.select(id_, *cells, RUN)
        rows = numbered.drop(id_, RUN)
    table = key(name, rows.select(*natural_key), natural_key, id_)
    if not cells:
        return table, None
    keyed = _join_back(rows.select(*natural_key, *cells), table, natural_key, id_)
    return table, cut(keyed.select(id_, *cells), f"{name}-keyed")


def _keyed_bridge(key: _Keyer, name: str, id_: str, keyed: DataFrame, fact_id: str, items, dim: DataFrame,
                  dim_name: str, dim_id: str, note: str) -> DataFrame:
    """Rows (fact, item, note) of arrays of struct(value, note), each once, with a key in their order."""
    order = [fact_id, dim_id, note]
    in_runs = RUN in keyed.columns and facts.fits_broadcast(dim, VOCABULARY_ROWS)
    kept = [fact_id, RUN] if in_runs else [fact_id]
    rows = (keyed.select(*kept, F.explode(items).alias("__item"))
            .select(*kept, F.col("__item.value").alias("__value"), F.col("__item.note").alias(note)))
    rows = facts.lookup(rows, dim, "__value", dim_name, dim_id, broadcast_max_rows=VOCABULARY_ROWS)
    if in_runs:
        # a fact row's items differ, and so do their keys: every item is in the vocabulary
        return key_in_runs(rows.select(*order, RUN), order, id_, RUN).select(id_, *order)
    return key(name, rows.select(*order), order, id_)


# table -> the tables that its rows refer to
REFERS_TO = {
    "areas": (), "parks": ("areas",), "parkvariants": ("areas",), "parksections": (),
    "parkconditions": (), "parklitters": (), "animals": (), "weathers": (),
    "parkstatus": ("parksections", "parkconditions", "parklitters"),
    "parkstatuswheater": ("parkstatus", "weathers"), "parkstatusanimals": ("parkstatus", "animals"),
    "colors": (), "locations": (), "activities": (), "interactions": (), "squirrels": ("colors",),
    "squirrelhighlights": ("squirrels", "colors"),
    "squirrelhumaninteractions": ("squirrels", "interactions"),
    "squirrellocations": ("squirrels", "locations"), "squirrelactivities": ("squirrels", "activities"),
}


# table -> the staged columns that it is made of, besides those of the tables it refers to
MADE_OF = {
    "areas": ("AreaID", "AreaName"), "parks": ("ParkID", "ParkName"), "parkvariants": ("ParkID", "ParkName"),
    "parksections": ("ParkID", "ParkName"), "parkconditions": ("ParkConditions",), "parklitters": ("Litter",),
    "animals": ("OtherAnimalSightings",), "weathers": (TW,),
    "parkstatus": ("Date", "StartTime", "EndTime", "TotalTimeinminutesifavailable", "TemperatureDegrees"),
    "parkstatuswheater": (), "parkstatusanimals": (),
    "colors": ("PrimaryFurColor", "HighlightsinFurColor"), "locations": ("Location",), "activities": ("Activities",),
    "interactions": ("InteractionswithHumans",),
    "squirrels": ("SquirrelID", "ParkID", "ColorNotes", "SpecificLocation", "OtherNotesorObservations",
                  "SquirrelLatitude", "SquirrelLongitude", "MinHeightFeet", "MaxHeightFeet"),
    "squirrelhighlights": (), "squirrelhumaninteractions": (), "squirrellocations": (), "squirrelactivities": (),
}


def _needed(staged: DataFrame, tables) -> DataFrame:
    """The staged columns that these tables are made of; the others need no cleaning and no writing."""
    columns = {c for name in tables for c in MADE_OF[name]}
    return staged.select(*[F.col(c) for c in staged.columns if c in columns])


def _with_references(tables) -> set[str]:
    found, left = set(), list(tables)
    while left:
        name = left.pop()
        if name not in found:
            found.add(name)
            left += REFERS_TO[name]
    return found


def normalize_survey(spark: SparkSession, visits: DataFrame, sightings: DataFrame,
                     store: str | None = None, cut_lineage: bool = True, only=None, keyed: bool = True,
                     **stage_opts) -> dict[str, DataFrame]:
    """Build the tables, or those of ``only`` and the ones they refer to.

    ``cut_lineage`` writes the staged inputs and each keyed table once below
    the checkpoint folder, so the passes that number and join back read files
    instead of recomputing the staging. ``keyed=False`` leaves the key of the
    sightings out where no bridge needs it (reports that only count them)."""
    key = _Keyer(spark, store)
    wanted = _with_references(REFERS_TO if only is None else only)
    t: dict[str, DataFrame] = {}
    if wanted & VISIT_TABLES:
        _visit_tables(spark, visits, store, cut_lineage, key, wanted, t, **stage_opts)
    if wanted & SIGHTING_TABLES:
        _sighting_tables(sightings, cut_lineage, key, wanted, t, keyed or store is not None)
    return t


SIGHTING_TABLES = {"colors", "locations", "activities", "interactions", "squirrels", "squirrelhighlights",
                   "squirrelhumaninteractions", "squirrellocations", "squirrelactivities"}
BRIDGES_OF_SIGHTINGS = {"squirrelhighlights", "squirrelhumaninteractions", "squirrellocations", "squirrelactivities"}
VISIT_TABLES = set(REFERS_TO) - SIGHTING_TABLES


def _visit_tables(spark, visits, store, cut_lineage, key, wanted, t, **stage_opts) -> None:
    cut = (lambda df, label: materialize(df, f"survey-{label}")) if cut_lineage else \
        (lambda df, label: df)
    v = cut(_needed(stage_visits(visits, **stage_opts), wanted & VISIT_TABLES), "visits")
    hid = P.split_hier_id("ParkID")

    # areas, parks, sections (natural park IDs are kept)
    if "areas" in wanted:
        t["areas"] = key("areas", v.select(F.col("AreaID").alias("Area_ID"), "AreaName"),
                         ["AreaName", "Area_ID"], "AreaID", ["AreaName", "Area_ID"])
    if wanted & {"parks", "parkvariants"}:
        named = (v.select("ParkID", "AreaName", "AreaID", "ParkName").distinct()      # parsed once each
                 .select(hid["parent"].alias("ParkID"), "AreaName", F.col("AreaID").alias("Area_ID"),
                         P.strip_parens("ParkName").alias("ParkName")).distinct())
        named = _join_back(named, t["areas"], ["AreaName", "Area_ID"], "AreaID", VOCABULARY_ROWS)
        # every (name, area) seen for an ID; a park takes its smallest, the audit counts the others
        variants = cut(named.select("ParkID", "AreaID", "ParkName", "AreaName", "Area_ID"), "parkvariants")
        t["parkvariants"] = variants.select("ParkID", "AreaID", "ParkName")
        park_rows = (variants.groupBy("ParkID")
                     .agg(F.min(F.struct("ParkName", "AreaName", "Area_ID", "AreaID")).alias("r"))
                     .select("ParkID", F.col("r.AreaID").alias("AreaID"), F.col("r.ParkName").alias("ParkName")))
        t["parks"] = cut(park_rows, "parks") if store is None else merge_into_path(
            spark, f"{store.rstrip('/')}/parks", park_rows, ["ParkID"], None,
            schema=SCHEMAS["parks"])
    if "parksections" in wanted:
        t["parksections"] = key("parksections", dims.section_rows(v.select("ParkID", "ParkName").distinct(), "ParkID", "ParkName"),
                                ["ParkID", "SectionID", "ParkSectionName"], "ParkSectionID")

    # single-valued vocabularies from the head of a "value, remark" cell
    if "parkconditions" in wanted:
        cond = P.split_head_tail(X.strip_quotes("ParkConditions"))
        v = v.withColumns({"ParkCondition": X.missing_to(cond["head"]), "ConditionsObs": cond["tail"]})
        t["parkconditions"] = key("parkconditions",
                                  v.select(F.col("ParkCondition").alias("ParkConditionName")),
                                  ["ParkConditionName"], "ParkConditionID")
    if "parklitters" in wanted:
        litter = P.split_head_tail(X.strip_quotes("Litter"))
        v = v.withColumns({"ParkLitter": X.missing_to(litter["head"]), "LitterObs": litter["tail"]})
        t["parklitters"] = key("parklitters", v.select(F.col("ParkLitter").alias("ParkLitterName")),
                               ["ParkLitterName"], "ParkLitterID")

    # multi-valued vocabularies: one parser for vocabulary and bridge
    if "animals" in wanted:
        animal_items = F.transform(P.items_outside_parens("OtherAnimalSightings"),
                                   lambda x: P.split_note(x)["value"])
        t["animals"] = key("animals", v.select("OtherAnimalSightings").distinct()
                           .select(F.explode(animal_items).alias("AnimalName"))
                           .where(F.col("AnimalName") != ""), ["AnimalName"], "AnimalID")
    if "weathers" in wanted:
        weather = P.descriptors_after(TW)
        v = v.withColumns({"WeatherItems": weather["items"], "WeatherObs": weather["clause"]})
        t["weathers"] = key("weathers", v.select(TW).distinct().select(F.explode(weather["items"]).alias("WeatherName")),
                            ["WeatherName"], "WeatherID")
    if "parkstatus" not in wanted:
        return

    # visit fact: keyed once on its natural key
    # a visit belongs to the section named in its park name, matched on the
    # sections' natural key (the section number may be absent: NULL-safe)
    v = v.withColumns({"__pid": hid["parent"], "__sid": hid["child"],
                       "__sname": P.section_name("ParkName")})
    secs = t["parksections"].select(F.col("ParkID").alias("__spid"),
                                    F.col("SectionID").alias("__ssid"),
                                    F.col("ParkSectionName").alias("__ssname"), "ParkSectionID")
    secs = facts.checked_broadcast(secs, VOCABULARY_ROWS)
    v = v.join(secs, (v["__pid"] == secs["__spid"]) & v["__sid"].eqNullSafe(secs["__ssid"])
               & (v["__sname"] == secs["__ssname"]), "left").drop("__spid", "__ssid", "__ssname")
    v = facts.lookup(v, t["parkconditions"], "ParkCondition", "ParkConditionName",
                     "ParkConditionID", broadcast_max_rows=VOCABULARY_ROWS)
    v = facts.lookup(v, t["parklitters"], "ParkLitter", "ParkLitterName", "ParkLitterID",
                     broadcast_max_rows=VOCABULARY_ROWS)
    status_cols = ["ParkID", "ParkSectionID", "Date", "StartTime", "EndTime", "TotalTime",
                   "ParkConditionID", "ConditionsObs", "ParkLitterID", "LitterObs",
                   "TemperatureDegrees"]
    v = v.withColumns({"ParkID": F.col("__pid"),
                       "TotalTime": F.col("TotalTimeinminutesifavailable")})
    cells = ([] if "parkstatuswheater" not in wanted else ["WeatherItems", "WeatherObs"]) + \
        ([] if "parkstatusanimals" not in wanted else ["OtherAnimalSightings"])
    t["parkstatus"], v = _fact_with_cells(key, "parkstatus", v, status_cols, "ParkStatusID", cells, cut)

    # visit bridges
    if "parkstatuswheater" in wanted:
        items = F.array_distinct(F.transform("WeatherItems", lambda x: F.struct(
            x.alias("value"), F.col("WeatherObs").alias("note"))))
        t["parkstatuswheater"] = _keyed_bridge(key, "parkstatuswheater", "ParkStatusWheaterID", v, "ParkStatusID", items,
                                               t["weathers"], "WeatherName", "WeatherID", "WeatherObs")
    if "parkstatusanimals" in wanted:
        t["parkstatusanimals"] = _keyed_bridge(key, "parkstatusanimals", "ParkStatusAnimalID", v, "ParkStatusID",
                                               facts.noted_items("OtherAnimalSightings"), t["animals"], "AnimalName",
                                               "AnimalID", "ParkStatusAnimalObs")


def _sighting_tables(sightings, cut_lineage, key, wanted, t, keyed=True) -> None:
    cut = (lambda df, label: materialize(df, f"survey-{label}")) if cut_lineage else \
        (lambda df, label: df)
    s = cut(_needed(stage_sightings(sightings), wanted & SIGHTING_TABLES), "sightings")
    for name, cols, value, id_ in [
        ("colors", ["PrimaryFurColor", "HighlightsinFurColor"], "ColorName", "ColorID"),
        ("locations", ["Location"], "LocationName", "LocationID"),
        ("activities", ["Activities"], "ActivityName", "ActivityID"),
        ("interactions", ["InteractionswithHumans"], "InteractionName", "InteractionID"),
    ]:
        if name in wanted:
            t[name] = key(name, _items(s, cols, value), [value], id_)
    if "squirrels" not in wanted:
        return

    # sighting fact: primary colour and first highlight are two roles of one vocabulary
    # as a column the first highlight is found once, not for each part of its parser
    s = s.withColumn("__first", F.get(P.items_outside_parens("HighlightsinFurColor"), 0))
    s = facts.build_fact(s, [
        dict(dim=t["colors"], on=F.trim("PrimaryFurColor"), dim_name="ColorName",
             dim_key="ColorID", as_="SquirrelPrimFurColorID", broadcast_max_rows=VOCABULARY_ROWS),
        dict(dim=t["colors"], on=P.split_note("__first")["value"], dim_name="ColorName",
             dim_key="ColorID", as_="SquirrelHighFurColorID", broadcast_max_rows=VOCABULARY_ROWS)])
    s = s.withColumns({"SquirrelColorNotes": F.col("ColorNotes"),
                       "SquirrelSpecificLocation": F.col("SpecificLocation"),
                       "SquirrelObservations": F.col("OtherNotesorObservations"),
                       "SquirrelMinHeightFeet": F.col("MinHeightFeet"),
                       "SquirrelMaxHeightFeet": F.col("MaxHeightFeet")})
    sq_cols = ["SquirrelID", "ParkID", "SquirrelPrimFurColorID", "SquirrelHighFurColorID",
               "SquirrelColorNotes", "SquirrelSpecificLocation", "SquirrelObservations",
               "SquirrelLatitude", "SquirrelLongitude", "SquirrelMinHeightFeet",
               "SquirrelMaxHeightFeet"]
    if not keyed and not wanted & BRIDGES_OF_SIGHTINGS:
        t["squirrels"] = s.select(*sq_cols).distinct()
        return
    bridges = [(name, *rest) for name, *rest in [
        ("squirrelhighlights", "HighlightsinFurColor", "colors", "ColorName", "ColorID",
         "SquirrelHighlightObs"),
        ("squirrelhumaninteractions", "InteractionswithHumans", "interactions",
         "InteractionName", "InteractionID", "SquirrelHumanInteractionObs"),
        ("squirrellocations", "Location", "locations", "LocationName", "LocationID",
         "SquirrelLocationObs"),
        ("squirrelactivities", "Activities", "activities", "ActivityName", "ActivityID",
         "SquirrelActivityObs"),
    ] if name in wanted]
    t["squirrels"], s = _fact_with_cells(key, "squirrels", s, sq_cols, "SquirrelDataID",
                                         [col for _, col, *_ in bridges], cut)
    for name, col, dim, dname, dkey, note in bridges:
        t[name] = _keyed_bridge(key, name, _bridge_key_name(name), s, "SquirrelDataID", facts.noted_items(col), t[dim],
                                dname, dkey, note)


def _bridge_key_name(table: str) -> str:
    return {"squirrelhighlights": "SquirrelHighlightID",
            "squirrelhumaninteractions": "SquirrelHumanInteractionID",
            "squirrellocations": "SquirrelLocationID",
            "squirrelactivities": "SquirrelActivityID"}[table]


def _items(df: DataFrame, cols, name: str) -> DataFrame:
    """The items of the cells; each distinct cell is parsed once."""
    cell = F.concat_ws(",", *[F.col(c) for c in cols])
    vals = F.transform(P.items_outside_parens("__cell"), lambda x: P.split_note(x)["value"])
    return (df.select(cell.alias("__cell")).distinct()
            .select(F.explode(vals).alias(name)).where(F.col(name) != ""))


# -- contracts, audit, reports -------------------------------------------------------------

_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType(),
          "string": T.StringType()}


def _spec(name: str, ddl: str, required=(), lengths=None, refs=()) -> TableSpec:
    """A contract from "name type, ..." whose first column is the primary key."""
    schema = T.StructType([T.StructField(column, _TYPES[kind]) for column, kind in map(str.split, ddl.split(", "))])
    key = schema.fields[0].name
    return TableSpec(name, schema=schema, primary_key=(key,), not_null=(key, *required),
                     max_length=lengths or {}, foreign_keys=tuple(refs))


def _vocabulary(name: str, key: str, column: str, length: int = 50) -> TableSpec:
    return _spec(name, f"{key} bigint, {column} string", (column,), {column: length})


def _bridge(name: str, key: str, fact: str, item: str, note: str, fact_table: str, item_table: str) -> TableSpec:
    return _spec(name, f"{key} bigint, {fact} bigint, {item} bigint, {note} string", (), {note: 250},
                 (fk(fact, fact_table), fk(item, item_table)))


# the lengths and required columns are fixed values of the declared schema
SPECS = [
    _spec("areas", "AreaID bigint, AreaName string, Area_ID string", ("AreaName",), {"AreaName": 50, "Area_ID": 5}),
    _spec("parks", "ParkID bigint, AreaID bigint, ParkName string", ("ParkName",), {"ParkName": 50},
          (fk("AreaID", "areas"),)),
    _spec("parkvariants", "ParkID bigint, AreaID bigint, ParkName string", (), {"ParkName": 50}),
    _spec("parksections", "ParkSectionID bigint, ParkID bigint, SectionID bigint, ParkSectionName string", (),
          {"ParkSectionName": 50}, (fk("ParkID", "parks"),)),
    _spec("parkstatus", "ParkStatusID bigint, ParkID bigint, ParkSectionID bigint, Date date, StartTime string, "
          "EndTime string, TotalTime int, ParkConditionID bigint, ConditionsObs string, ParkLitterID bigint, "
          "LitterObs string, TemperatureDegrees int", ("ParkID", "Date", "StartTime", "EndTime"),
          {"ConditionsObs": 250, "LitterObs": 250},
          (fk("ParkID", "parks"), fk("ParkSectionID", "parksections"), fk("ParkConditionID", "parkconditions"),
           fk("ParkLitterID", "parklitters"))),
    _spec("squirrels", "SquirrelDataID bigint, SquirrelID string, ParkID bigint, SquirrelPrimFurColorID bigint, "
          "SquirrelHighFurColorID bigint, SquirrelColorNotes string, SquirrelSpecificLocation string, "
          "SquirrelObservations string, SquirrelLatitude double, SquirrelLongitude double, "
          "SquirrelMinHeightFeet int, SquirrelMaxHeightFeet int", ("SquirrelID",),
          {"SquirrelID": 15, "SquirrelColorNotes": 250, "SquirrelSpecificLocation": 250, "SquirrelObservations": 250},
          (fk("ParkID", "parks"), fk("SquirrelPrimFurColorID", "colors", "ColorID"),
           fk("SquirrelHighFurColorID", "colors", "ColorID"))),
    _vocabulary("parkconditions", "ParkConditionID", "ParkConditionName"),
    _vocabulary("parklitters", "ParkLitterID", "ParkLitterName"),
    _vocabulary("animals", "AnimalID", "AnimalName"), _vocabulary("weathers", "WeatherID", "WeatherName"),
    _vocabulary("colors", "ColorID", "ColorName", 128), _vocabulary("locations", "LocationID", "LocationName"),
    _vocabulary("activities", "ActivityID", "ActivityName"),
    _vocabulary("interactions", "InteractionID", "InteractionName"),
    _bridge("parkstatuswheater", "ParkStatusWheaterID", "ParkStatusID", "WeatherID", "WeatherObs", "parkstatus",
            "weathers"),
    _bridge("parkstatusanimals", "ParkStatusAnimalID", "ParkStatusID", "AnimalID", "ParkStatusAnimalObs",
            "parkstatus", "animals"),
    _bridge("squirrelhighlights", "SquirrelHighlightID", "SquirrelDataID", "ColorID", "SquirrelHighlightObs",
            "squirrels", "colors"),
    _bridge("squirrelactivities", "SquirrelActivityID", "SquirrelDataID", "ActivityID", "SquirrelActivityObs",
            "squirrels", "activities"),
    _bridge("squirrelhumaninteractions", "SquirrelHumanInteractionID", "SquirrelDataID", "InteractionID",
            "SquirrelHumanInteractionObs", "squirrels", "interactions"),
    _bridge("squirrellocations", "SquirrelLocationID", "SquirrelDataID", "LocationID", "SquirrelLocationObs",
            "squirrels", "locations"),
]
SCHEMAS = {spec.name: spec.schema for spec in SPECS}


def survey_audit(t: dict[str, DataFrame]) -> DataFrame:
    return audit(t, SPECS)


REPORT_TABLES = {
    "query_1": ("squirrels", "parks"), "query_2": ("squirrels", "parks", "areas"),
    "query_3": ("parkstatusanimals", "parkstatus", "animals", "parks"),
    "query_4": ("squirrelactivities", "activities"), "query_5": ("squirrels", "parks", "colors"),
}


def survey_reports(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five reports, columns named as in the surveyed result files."""
    return {name: survey_report(t, name) for name in REPORT_TABLES}


def survey_report(t: dict[str, DataFrame], name: str) -> DataFrame:
    """One report; ``t`` needs the tables of ``REPORT_TABLES[name]``."""
    return {"query_1": _report_1, "query_2": _report_2, "query_3": _report_3, "query_4": _report_4,
            "query_5": _report_5}[name](t)


def _report_1(t: dict[str, DataFrame]) -> DataFrame:
    q1 = reports.count_distinct_by(t["squirrels"], "ParkID", "SquirrelID", "qty_squirrel",
                                   t["parks"], "ParkID", ["ParkName"])
    return q1.orderBy(F.asc_nulls_last("ParkID"))


def _report_2(t: dict[str, DataFrame]) -> DataFrame:
    q2 = reports.count_distinct_by_parent(t["squirrels"], "ParkID", "SquirrelID", t["parks"],
                                          "ParkID", "AreaID", "qty_squirrel", t["areas"],
                                          "AreaID", ["AreaName"])
    return q2.orderBy(F.asc_nulls_last("AreaID"))


def _report_3(t: dict[str, DataFrame]) -> DataFrame:
    q3 = reports.count_bridge(t["parkstatusanimals"], "ParkStatusID", "AnimalID",
                              t["parkstatus"], "ParkStatusID", "ParkID", "Total",
                              t["animals"], "AnimalID", ["AnimalName"], t["parks"], "ParkID",
                              ["ParkName"])
    return (q3.orderBy(F.asc_nulls_last("ParkID"), F.asc_nulls_last("AnimalName"))
            .select("ParkName", "AnimalName", "Total"))


def _report_4(t: dict[str, DataFrame]) -> DataFrame:
    q4 = reports.rank_by_frequency(t["squirrelactivities"], "ActivityID", t["activities"],
                                   "ActivityID", "ActivityName", "Top", "TopActivities")
    return q4.orderBy("Top")


def _report_5(t: dict[str, DataFrame]) -> DataFrame:
    q5 = reports.count_by_attribute(t["squirrels"], "ParkID", "SquirrelPrimFurColorID", "Total",
                                    t["parks"], "ParkID", ["ParkName"], t["colors"], "ColorID",
                                    ["ColorName"], keep_attr_key=False)
    return (q5.withColumnRenamed("ColorName", "PrimaryFurColors")
            .orderBy(F.asc_nulls_last("ParkID"), "Total", F.asc_nulls_last("PrimaryFurColors")))


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Expose the tables as temporary views, so report SQL written for the
    stored tables runs unchanged in Spark SQL (``spark.sql(text)``)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
