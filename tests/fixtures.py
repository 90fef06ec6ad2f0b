"""Small survey-shaped inputs of our own making (raw headers, messy text)."""

from pyspark.sql import types as T

VISIT_HEADERS = ["Area Name", "Area ID", "Park Name", "Park ID", "Date", "Start Time",
                 "End Time", "Total Time (in minutes, if available)", "Park Conditions",
                 "Other Animal Sightings", "Litter", "Temperature & Weather"]

VISITS = [
    ("RIVERBANK", "R", "Orchard Green", "1", "9/14/21", "8:05:30 AM", "8:45:30 AM", "40", "Empty",
     "Geese, Foxes, Hens", "Little", "17 degrees, foggy"),
    ("RIVERBANK", "R", "Mill Meadow", "2", "9/14/21", "9:10:00 AM", "9:55:00 AM", "", "Muddy",
     "Geese, Foxes (2, one limping), Toads (9)", "Little, near the gate", "damp, dim"),
    ("RIVERBANK", "R", "Canal Walk (Section North of the Lock)", "3.1", "9/15/21", "1:00:00 PM",
     "1:25:00 PM", "25", "Muddy, school outing", "Geese, Hens", "Nothing",
     "21-odd degrees, but hazy!"),
    ("RIVERBANK", "R", "Canal Walk (Section by the Tow Path)", "3.2", "9/15/21", "1:40:00 PM",
     "2:05:00 PM", "25", '"Lovely" - Kim', "Geese, Otter", "", "22.5 degrees, hazy, with two showers"),
    ("HILLTOP", "H", "Beacon Field", "4", "9/15/21", "11:35:00 PM", "12:15:00 AM", None, None,
     None, None, None),
]

SIGHTING_HEADERS = ["SquirrelID", "Park ID", "Primary Fur Color", "Highlights in Fur Color",
                    "Color Notes", "Above Ground (Height in Feet)", "Location",
                    "Specific Location", "Activities", "Interactions with Humans",
                    "Other Notes or Observations", "Squirrel Latitude (DD.DDDDDD)",
                    "Squirrel Longitude (-DD.DDDDDD)"]

SIGHTINGS = [
    ("Q-7", "1", "Russet", "Amber, Cream", "", "4-9", "Low Wall", "by the well",
     "Digging, Napping (twice)", "Curious", "", "51.50", "-0.12"),
    ("Q-7", "1", "Russet", "Amber, Cream", "", "4-9", "Low Wall", "by the well",
     "Digging, Napping (twice)", "Curious", "", "51.50", "-0.12"),
    ("Q-8", "1", "Slate", "", "pale ears", "<7", "Up High (roof, gutter)", "",
     "Leaping", "Flees", "", "51.501", "-0.121"),
    ("R-2", "2", "Amber", "Russet", "", "", "Low Wall", "",
     "Sprinting, Sparring (with a rival, loudly)", "Begs, Curious", "", "51.49", "-0.13"),
    ("T-1", "3.1", "Russet", "", "", "6 or 11", "Up High", "", "Digging",
     "", "", "51.61", "-0.19"),
    ("T-2", "3", "Russet", "Cream", "", ">25", "Up High", "", "Digging, Leaping",
     "Staring", "", "51.611", "-0.191"),
]


def visits_df(spark):
    schema = T.StructType([T.StructField(h, T.StringType()) for h in VISIT_HEADERS])
    return spark.createDataFrame(VISITS, schema)


def sightings_df(spark):
    schema = T.StructType([T.StructField(h, T.StringType()) for h in SIGHTING_HEADERS])
    return spark.createDataFrame(SIGHTINGS, schema)
