"""Registered queries on the supplied tables, each with its DuckDB oracle SQL.

Every query reads whole tables (``region nation customer supplier part orders
lineitem events documents ...``) and exercises one operator. Composed text
columns (lists with notes, ranges, clauses, dates as text) are built from the
tables with the same expression on both sides, so the oracle sees the same
input. NULL and orphan cases are made with ``nullif`` or a filter on both
sides. Column names are aliased identically in Spark and SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyspark.functions import parse as P
from tidyspark.functions import text as X
from tidyspark.operators import dims, facts, reports
from tidyspark.operators.audit import audit
from tidyspark.operators.keys import dense_key
from tidyspark.operators.merge import merge_new_rows
from tidyspark.session import scratch_path
from tidyspark.sources.headers import normalize_headers
from tidyspark.sources.tables import read_csv, read_table, write_table
from tidyspark.specs import TableSpec, fk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# -- composed columns (same text on both sides) ----------------------------------------
# list with a note holding a comma, and a clause:  p_name || ' (' || p_size || ', ' ||
# p_type || '), ' || p_brand || ' but ' || p_type
def _noted_list():
    return F.concat(F.col("p_name"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(", "),
                    F.col("p_type"), F.lit("), "), F.col("p_brand"), F.lit(" but "),
                    F.col("p_type"))


NOTED_LIST_SQL = "p_name || ' (' || p_size || ', ' || p_type || '), ' || p_brand || ' but ' || p_type"


# ==== reports (B22) =======================================================================

@register("q1_count_distinct_by", """
SELECT q.l_suppkey, s.s_name, COUNT(*) AS qty
FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) q
LEFT JOIN supplier s ON q.l_suppkey = s.s_suppkey
GROUP BY q.l_suppkey, s.s_name
""")
def q1(spark, d):
    return reports.count_distinct_by(load(spark, d, "lineitem"), "l_suppkey", "l_partkey", "qty",
                                     dim=load(spark, d, "supplier"), dim_key="s_suppkey",
                                     dim_cols=["s_name"])


@register("q2_count_distinct_by_parent", """
SELECT q.s_nationkey, n.n_name, COUNT(*) AS qty
FROM (SELECT DISTINCT s.s_nationkey, l.l_partkey
      FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey) q
LEFT JOIN nation n ON q.s_nationkey = n.n_nationkey
GROUP BY q.s_nationkey, n.n_name
""")
def q2(spark, d):
    return reports.count_distinct_by_parent(
        load(spark, d, "lineitem"), "l_suppkey", "l_partkey", load(spark, d, "supplier"),
        "s_suppkey", "s_nationkey", "qty", grand_dim=load(spark, d, "nation"),
        grand_dim_key="n_nationkey", grand_cols=["n_name"])


@register("q3_count_bridge", """
SELECT q.o_custkey, c.c_name, q.l_partkey, p.p_name, COUNT(*) AS total
FROM (SELECT o.o_custkey, l.l_partkey
      FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey) q
LEFT JOIN part p ON q.l_partkey = p.p_partkey
LEFT JOIN customer c ON q.o_custkey = c.c_custkey
GROUP BY q.o_custkey, c.c_name, q.l_partkey, p.p_name
""")
def q3(spark, d):
    return reports.count_bridge(
        load(spark, d, "lineitem"), "l_orderkey", "l_partkey", load(spark, d, "orders"),
        "o_orderkey", "o_custkey", "total", item_dim=load(spark, d, "part"),
        item_dim_key="p_partkey", item_cols=["p_name"], group_dim=load(spark, d, "customer"),
        group_dim_key="c_custkey", group_cols=["c_name"])


@register("q3_count_bridge_by_attributes", """
SELECT o.o_orderpriority, p.p_type, COUNT(*) AS total
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY o.o_orderpriority, p.p_type
""")
def q3_attrs(spark, d):
    return reports.count_bridge(
        load(spark, d, "lineitem"), "l_orderkey", "l_partkey", load(spark, d, "orders"),
        "o_orderkey", "o_orderpriority", "total", item_dim=load(spark, d, "part"),
        item_dim_key="p_partkey", item_attr="p_type")


def _event_types(spark, d):
    ev = load(spark, d, "events")
    vocab = dims.dim_from_column(ev, X.clean("event_type"), "event_type_name", "event_type_id")
    fact = facts.lookup(ev.select("event_id", "event_type"), vocab, F.trim("event_type"),
                        "event_type_name", "event_type_id")
    return fact, vocab


@register("q4_rank_by_frequency", """
SELECT ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, event_type ASC NULLS LAST) AS Top,
       event_type AS TopActivities
FROM events GROUP BY event_type
""")
def q4(spark, d):
    fact, vocab = _event_types(spark, d)
    return reports.rank_by_frequency(fact, "event_type_id", vocab, "event_type_id",
                                     "event_type_name", "Top", "TopActivities")


@register("q4_rank_words", """
WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, word ASC NULLS LAST) AS Top,
       word AS TopActivities, COUNT(*) AS n
FROM w WHERE word <> '' GROUP BY word
""")
def q4_words(spark, d):
    part = load(spark, d, "part")
    words = dims.dim_from_list(part, "p_name", "word", "word_id", sep=" ", strip_notes=False)
    br = facts.bridge(part, "p_partkey", "p_name", words, "word", "word_id", sep=" ")
    return reports.rank_by_frequency(br, "word_id", words, "word_id", "word", "Top",
                                     "TopActivities", count_name="n")


@register("q5_count_by_attribute", """
SELECT c.c_nationkey, n.n_name, c.c_mktsegment AS segment, COUNT(*) AS total
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY c.c_nationkey, n.n_name, c.c_mktsegment
""")
def q5(spark, d):
    cust = load(spark, d, "customer")
    seg = dims.dim_from_column(cust, "c_mktsegment", "segment", "segment_id")
    fact = facts.lookup(cust, seg, F.trim("c_mktsegment"), "segment", "segment_id")
    return reports.count_by_attribute(fact, "c_nationkey", "segment_id", "total",
                                      group_dim=load(spark, d, "nation"),
                                      group_dim_key="n_nationkey", group_cols=["n_name"],
                                      attr_dim=seg, attr_dim_key="segment_id",
                                      attr_cols=["segment"], keep_attr_key=False)


# ==== sources (B1, B23) ====================================================================

_RAW_HEADERS = {"c_custkey": "Cust Key", "c_name": "Customer Name (full)", "c_nationkey": "Nation, Key",
                "c_acctbal": "Account Balance, USD", "c_mktsegment": "Market Segment"}
HEADERS_SQL = """
SELECT c_custkey AS CustKey, c_name AS CustomerNamefull, c_nationkey AS NationKey, c_acctbal AS AccountBalanceUSD,
       c_mktsegment AS MarketSegment
FROM customer
"""


@register("headers", HEADERS_SQL)
def headers(spark, d):
    cust = load(spark, d, "customer")
    raw = cust.select(*[F.col(k).alias(v) for k, v in _RAW_HEADERS.items()])
    return normalize_headers(raw)


@register("csv_roundtrip", HEADERS_SQL)
def csv_roundtrip(spark, d):
    cust = load(spark, d, "customer")
    raw = cust.select(*[F.col(k).alias(v) for k, v in _RAW_HEADERS.items()])
    path = scratch_path(spark, "csv-roundtrip")
    raw.write.option("header", True).csv(path)
    schema = raw.schema  # declared types, raw header order
    return normalize_headers(read_csv(spark, path, schema, normalize=False))


@register("parquet_roundtrip", HEADERS_SQL)
def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "parquet-roundtrip")
    write_table(headers(spark, d), path)
    return read_table(spark, path)


# ==== cleaning (B2, B3) ====================================================================

@register("clean_documents", r"""
SELECT doc_id,
       coalesce(nullif(trim(regexp_replace(text, '[^a-zA-Z0-9 \t\n\r\f#(),:]', '', 'g')), ''),
                'ND') AS clean_text
FROM documents
""")
def clean_documents(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.col("text").alias("clean_text"))
    return X.clean_text(docs, {"clean_text": (X.KEEP_TEXT, "", X.MISSING)})


@register("fill_default", """
SELECT c_custkey, coalesce(nullif(nullif(c_mktsegment, 'FURNITURE'), ''), 'ND') AS c_mktsegment
FROM customer
""")
def fill_default(spark, d):
    cust = load(spark, d, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("c_mktsegment"))
    return X.fill_default(cust, ["c_mktsegment"])


# ==== parsers (B4-B8, B14-B19) ===============================================================

@register("parse_dates", """
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%-m/%-d/%Y') AS date_text FROM orders)
SELECT o_orderkey, date_text, CAST(strptime(date_text, '%m/%d/%Y') AS DATE) AS order_date,
       strftime(CAST(strptime(date_text, '%m/%d/%Y') AS DATE), '%d/%m/%Y') AS order_date_dmy
FROM t
""")
def parse_dates(spark, d):
    o = load(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("date_text"))
    dt = P.parse_date("date_text", "M/d/yyyy")
    return o.select("o_orderkey", "date_text", dt.alias("order_date"),
                    P.format_date(dt, "dd/MM/yyyy").alias("order_date_dmy"))


@register("parse_time", """
WITH t AS (SELECT event_id, strftime(ts, '%-I:%M:%S %p') AS time_text FROM events)
SELECT event_id, time_text, strftime(strptime(time_text, '%I:%M:%S %p'), '%H:%M:%S') AS time_24
FROM t
""")
def parse_time(spark, d):
    e = load(spark, d, "events").select(
        "event_id", F.date_format("ts", "h:mm:ss a").alias("time_text"))
    return e.select("event_id", "time_text", P.parse_time("time_text").alias("time_24"))


@register("fill_minutes", """
WITH t AS (
  SELECT event_id,
         strftime(ts, '%H:%M:%S') AS start_t,
         strftime(ts + to_minutes(CAST((event_id * 7) % 600 AS BIGINT)), '%H:%M:%S') AS end_t,
         CASE WHEN event_type = 'view' THEN 'n/a'
              WHEN event_type = 'click' THEN NULL
              ELSE CAST((event_id * 7) % 600 AS VARCHAR) END AS stated
  FROM events),
s AS (
  SELECT *, (hour(strptime(end_t, '%H:%M:%S')) * 3600 + minute(strptime(end_t, '%H:%M:%S')) * 60
             + second(strptime(end_t, '%H:%M:%S')))
          - (hour(strptime(start_t, '%H:%M:%S')) * 3600 + minute(strptime(start_t, '%H:%M:%S')) * 60
             + second(strptime(start_t, '%H:%M:%S'))) AS diff
  FROM t)
SELECT event_id, start_t, end_t, stated,
       coalesce(TRY_CAST(trim(stated) AS INTEGER),
                CAST(floor((CASE WHEN diff < 0 THEN diff + 86400 ELSE diff END) / 60) AS INTEGER))
         AS minutes
FROM s
""")
def fill_minutes(spark, d):
    e = load(spark, d, "events")
    m = (F.col("event_id") * 7) % 600
    t = e.select(
        "event_id",
        F.date_format("ts", "HH:mm:ss").alias("start_t"),
        F.date_format(F.col("ts") + F.make_dt_interval(mins=m.cast("int")), "HH:mm:ss")
         .alias("end_t"),
        F.when(F.col("event_type") == "view", F.lit("n/a"))
         .when(F.col("event_type") == "click", F.lit(None).cast("string"))
         .otherwise(m.cast("string")).alias("stated"))
    return t.withColumn("minutes", P.fill_minutes("stated", "start_t", "end_t"))


_RANGE_SQL = """CASE WHEN p_type = 'SMALL' THEN '<' || p_size
            WHEN p_type = 'ECONOMY' THEN p_size || '-' || (p_size + 5)
            WHEN p_type = 'LARGE' THEN '>' || p_size
            WHEN p_type = 'STANDARD' THEN p_size || ' or ' || (p_size + 2)
            WHEN p_type = 'PROMO' THEN NULL
            ELSE 'unknown' END"""


def _range_text():
    size = F.col("p_size").cast("string")
    return (F.when(F.col("p_type") == "SMALL", F.concat(F.lit("<"), size))
            .when(F.col("p_type") == "ECONOMY",
                  F.concat(size, F.lit("-"), (F.col("p_size") + 5).cast("string")))
            .when(F.col("p_type") == "LARGE", F.concat(F.lit(">"), size))
            .when(F.col("p_type") == "STANDARD",
                  F.concat(size, F.lit(" or "), (F.col("p_size") + 2).cast("string")))
            .when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
            .otherwise(F.lit("unknown")))


@register("parse_range", f"""
WITH t AS (SELECT p_partkey, {_RANGE_SQL} AS height FROM part),
n AS (SELECT *, list_transform(regexp_extract_all(height, '(\\d+)', 1),
                               lambda x: TRY_CAST(x AS INTEGER)) AS nums FROM t)
SELECT p_partkey, height,
       CASE WHEN coalesce(len(nums), 0) = 0 THEN NULL
            WHEN contains(height, '<') THEN 0 ELSE list_min(nums) END AS min_height,
       CASE WHEN coalesce(len(nums), 0) = 0 THEN NULL
            WHEN contains(height, '>') AND NOT contains(height, '<') THEN NULL
            ELSE list_max(nums) END AS max_height
FROM n
""")
def parse_range(spark, d):
    t = load(spark, d, "part").select("p_partkey", _range_text().alias("height"))
    r = P.parse_range("height")
    return t.select("p_partkey", "height", r["min"].alias("min_height"),
                    r["max"].alias("max_height"))


_TEMP_SQL = """CASE WHEN p_type = 'SMALL' THEN p_size || '-ish degrees, but ' || p_name
            WHEN p_type = 'LARGE' THEN p_name || ' ' || p_size
            ELSE p_size || ' degrees, ' || p_name END"""


def _temp_text():
    size = F.col("p_size").cast("string")
    return (F.when(F.col("p_type") == "SMALL",
                   F.concat(size, F.lit("-ish degrees, but "), F.col("p_name")))
            .when(F.col("p_type") == "LARGE", F.concat(F.col("p_name"), F.lit(" "), size))
            .otherwise(F.concat(size, F.lit(" degrees, "), F.col("p_name"))))


@register("extract_number", f"""
WITH t AS (SELECT p_partkey, {_TEMP_SQL} AS weather FROM part)
SELECT p_partkey, weather,
       TRY_CAST(nullif(regexp_extract(weather, '(\\d+)(?:-?[A-Za-z]+)?\\s*degrees', 1), '')
                AS INTEGER) AS degrees
FROM t
""")
def extract_number(spark, d):
    t = load(spark, d, "part").select("p_partkey", _temp_text().alias("weather"))
    return t.withColumn("degrees", P.extract_number("weather"))


@register("head_tail", """
WITH t AS (SELECT o_orderkey,
                  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority
                       ELSE o_orderpriority || ', ' || o_orderstatus END AS cond
           FROM orders)
SELECT o_orderkey, cond, trim(split_part(cond, ',', 1)) AS head,
       CASE WHEN instr(cond, ',') > 0 THEN trim(substr(cond, instr(cond, ',') + 1))
            ELSE '' END AS tail
FROM t
""")
def head_tail(spark, d):
    o = load(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
         .otherwise(F.concat_ws(", ", "o_orderpriority", "o_orderstatus")).alias("cond"))
    ht = P.split_head_tail("cond")
    return o.select("o_orderkey", "cond", ht["head"].alias("head"), ht["tail"].alias("tail"))


@register("split_parens", f"""
SELECT p_partkey, trim(unnest(regexp_extract_all({NOTED_LIST_SQL},
                                                 '(?:[^,(]|\\([^)]*\\))+'))) AS item
FROM part
""")
def split_parens(spark, d):
    p = load(spark, d, "part")
    return p.select("p_partkey", F.explode(P.items_outside_parens(_noted_list())).alias("item"))


@register("split_note", f"""
WITH i AS (SELECT p_partkey, trim(unnest(regexp_extract_all({NOTED_LIST_SQL},
                                         '(?:[^,(]|\\([^)]*\\))+'))) AS item FROM part)
SELECT p_partkey, item, trim(regexp_replace(item, '\\([^)]*\\)', '', 'g')) AS value,
       array_to_string(list_transform(regexp_extract_all(item, '\\(([^)]*)\\)', 1), lambda x: trim(x)), ', ')
         AS note
FROM i
""")
def split_note(spark, d):
    i = split_parens(spark, d)
    n = P.split_note("item")
    return i.select("p_partkey", "item", n["value"].alias("value"), n["note"].alias("note"))


_CLAUSE_SQL = """CASE WHEN p_type = 'SMALL' THEN p_name || ' without ' || p_brand
            WHEN p_type = 'ECONOMY' THEN p_name || ', but ' || p_type
            WHEN p_type = 'MEDIUM' THEN p_name
            ELSE p_name || ' with ' || p_brand || ' but ' || p_type END"""


def _clause_text():
    return (F.when(F.col("p_type") == "SMALL",
                   F.concat(F.col("p_name"), F.lit(" without "), F.col("p_brand")))
            .when(F.col("p_type") == "ECONOMY",
                  F.concat(F.col("p_name"), F.lit(", but "), F.col("p_type")))
            .when(F.col("p_type") == "MEDIUM", F.col("p_name"))
            .otherwise(F.concat(F.col("p_name"), F.lit(" with "), F.col("p_brand"),
                                F.lit(" but "), F.col("p_type"))))


@register("split_many_notes", """
WITH i AS (SELECT p_partkey, p_name || ' (' || p_size || ')' || ' (' || p_type || ', all)' AS item FROM part)
SELECT p_partkey, item, p_name AS value, p_size || ', ' || p_type || ', all' AS note
FROM i JOIN part USING (p_partkey)
""")
def split_many_notes(spark, d):
    """Every note is kept: two parentheticals on one item."""
    i = load(spark, d, "part").select("p_partkey", F.concat(
        "p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(")"), F.lit(" ("), "p_type",
        F.lit(", all)")).alias("item"))
    n = P.split_note("item")
    return i.select("p_partkey", "item", n["value"].alias("value"), n["note"].alias("note"))


@register("open_paren_items", """
SELECT p_partkey, unnest([p_name, p_brand || ' (' || p_size || ', ' || p_type || ', rest']) AS item FROM part
""")
def open_paren_items(spark, d):
    """An unclosed parenthesis keeps its text, commas included, in one item."""
    cell = F.concat("p_name", F.lit(", "), "p_brand", F.lit(" ("), F.col("p_size").cast("string"), F.lit(", "),
                    "p_type", F.lit(", rest"))
    return load(spark, d, "part").select("p_partkey", F.explode(P.items_outside_parens(cell)).alias("item"))


@register("decimal_measures", """
SELECT p_partkey, p_size AS degrees, p_size AS minutes, unnest([p_name, 'felt like ' || p_size || ' degrees'])
         AS descriptor
FROM part
""")
def decimal_measures(spark, d):
    """Decimals before the unit, and a second marker after the first."""
    size = F.col("p_size").cast("string")
    t = load(spark, d, "part").select("p_partkey", F.concat(
        size, F.lit(".5 degrees, "), "p_name", F.lit(", felt like "), size, F.lit(" degrees")).alias("weather"),
        F.concat(size, F.lit(".5")).alias("stated"))
    return t.select("p_partkey", P.extract_number("weather").alias("degrees"),
                    P.fill_minutes("stated", F.lit("10:00:00"), F.lit("11:00:00")).alias("minutes"),
                    F.explode(P.descriptors_after("weather")["items"]).alias("descriptor"))


@register("items_documents", """
SELECT doc_id, count(*) AS n_items, CAST(sum(length(item)) AS BIGINT) AS n_chars, max(length(item)) AS longest
FROM (SELECT doc_id, trim(unnest(regexp_extract_all(text, '(?:[^,(]|\\([^)]*\\)?)+'))) AS item FROM documents)
GROUP BY doc_id
""")
def items_documents(spark, d):
    """List items of whole texts, line breaks and long items included."""
    items = load(spark, d, "documents").select("doc_id", F.explode(P.items_outside_parens("text")).alias("item"))
    return items.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_items"),
                                       F.sum(F.length("item")).alias("n_chars"),
                                       F.max(F.length("item")).cast("long").alias("longest"))


@register("clause_documents", """
WITH p AS (SELECT doc_id, text, length(regexp_extract(text, '^((?s).*?)\\b(?:but|with)\\b', 1)) AS before,
                  regexp_matches(text, '\\b(?:but|with)\\b') AS found FROM documents)
SELECT doc_id, CASE WHEN found THEN substr(text, before + 1) ELSE '' END AS clause FROM p
""")
def clause_documents(spark, d):
    """The clause of a whole text runs over its line breaks."""
    return load(spark, d, "documents").select("doc_id", P.cut_clause("text")["clause"].alias("clause"))


@register("cut_clause", f"""
WITH t AS (SELECT p_partkey, {_CLAUSE_SQL} AS remark FROM part)
SELECT p_partkey, remark,
       trim(regexp_replace(trim(regexp_replace(remark, '\\b(?:but|with)\\b.*$', '')),
                           '\\s*,$', '')) AS value,
       regexp_extract(remark, '\\b(?:but|with)\\b.*$', 0) AS clause
FROM t
""")
def cut_clause(spark, d):
    t = load(spark, d, "part").select("p_partkey", _clause_text().alias("remark"))
    c = P.cut_clause("remark")
    return t.select("p_partkey", "remark", c["value"].alias("value"), c["clause"].alias("clause"))


_DESC_SQL = """CASE WHEN p_type = 'SMALL' THEN p_size || ' degrees'
            WHEN p_type = 'ECONOMY' THEN replace(p_name, ' ', ', ')
            WHEN p_type = 'LARGE' THEN p_size || ' degrees, ' || replace(p_name, ' ', ', ')
                                       || ' with ' || p_brand
            WHEN p_type = 'PROMO' THEN NULL
            ELSE p_size || ' degrees, ' || p_name || ', but ' || p_type END"""


def _desc_text():
    size = F.col("p_size").cast("string")
    listed = F.regexp_replace("p_name", " ", ", ")
    return (F.when(F.col("p_type") == "SMALL", F.concat(size, F.lit(" degrees")))
            .when(F.col("p_type") == "ECONOMY", listed)
            .when(F.col("p_type") == "LARGE",
                  F.concat(size, F.lit(" degrees, "), listed, F.lit(" with "), F.col("p_brand")))
            .when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
            .otherwise(F.concat(size, F.lit(" degrees, "), F.col("p_name"), F.lit(", but "),
                                F.col("p_type"))))


DESCRIPTORS_SQL = f"""
WITH t AS (SELECT p_partkey, coalesce({_DESC_SQL}, '') AS weather FROM part),
a AS (SELECT p_partkey, weather,
             regexp_replace(weather, '\\d+(?:-?[A-Za-z]+)?\\s*degrees', '') AS after FROM t),
b AS (SELECT p_partkey, weather, regexp_extract(after, '\\b(?:but|with)\\b.*$', 0) AS clause,
             list_filter(list_transform(string_split(
                 regexp_replace(after, '\\b(?:but|with)\\b.*$', ''), ','), lambda x: trim(x)),
                 lambda x: x <> '') AS items FROM a)
SELECT p_partkey, clause,
       unnest(CASE WHEN len(items) = 0 THEN ['ND'] ELSE items END) AS descriptor
FROM b
"""


@register("descriptors", DESCRIPTORS_SQL)
def descriptors(spark, d):
    t = load(spark, d, "part").select("p_partkey", _desc_text().alias("weather"))
    ds = P.descriptors_after("weather")
    return t.select("p_partkey", ds["clause"].alias("clause"),
                    F.explode(ds["items"]).alias("descriptor"))


@register("hier_id", """
WITH t AS (SELECT CASE WHEN l_linenumber = 1 THEN CAST(l_orderkey AS VARCHAR)
                       ELSE l_orderkey || '.' || l_linenumber END AS hid FROM lineitem)
SELECT hid, TRY_CAST(nullif(split_part(hid, '.', 1), '') AS BIGINT) AS parent,
       TRY_CAST(nullif(split_part(hid, '.', 2), '') AS INTEGER) AS child
FROM t
""")
def hier_id(spark, d):
    li = load(spark, d, "lineitem")
    t = li.select(F.when(F.col("l_linenumber") == 1, F.col("l_orderkey").cast("string"))
                  .otherwise(F.concat_ws(".", "l_orderkey", "l_linenumber")).alias("hid"))
    h = P.split_hier_id("hid", type_="bigint")
    return t.select("hid", h["parent"].alias("parent"), h["child"].cast("int").alias("child"))


_SECTION_NAME_SQL = """CASE WHEN p_type IN ('SMALL', 'LARGE')
                 THEN p_name || ' (Section ' || p_brand || ' by section ' || p_type || ')' ELSE p_name END"""
_SECTION_ID_SQL = """CASE WHEN p_type IN ('SMALL', 'LARGE') THEN p_partkey || '.' || p_size
                 ELSE CAST(p_partkey AS VARCHAR) END"""


@register("sections", f"""
WITH t AS (SELECT {_SECTION_ID_SQL} AS pid, {_SECTION_NAME_SQL} AS pname FROM part),
s AS (SELECT DISTINCT TRY_CAST(split_part(pid, '.', 1) AS BIGINT) AS ParkID,
             TRY_CAST(nullif(split_part(pid, '.', 2), '') AS BIGINT) AS SectionID,
             array_to_string(list_transform(string_split(
                 trim(regexp_replace(substr(lower(pname), strpos(lower(pname), 'section') + 7),
                                     '\\)\\s*$', '')), ' '),
                 lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS ParkSectionName
      FROM t WHERE contains(lower(pname), 'section'))
SELECT ROW_NUMBER() OVER (ORDER BY ParkID NULLS FIRST, SectionID NULLS FIRST,
                          ParkSectionName NULLS FIRST) AS ParkSectionID,
       ParkID, SectionID, ParkSectionName
FROM s
""")
def sections(spark, d):
    p = load(spark, d, "part")
    sec = F.col("p_type").isin("SMALL", "LARGE")
    t = p.select(
        F.when(sec, F.concat_ws(".", "p_partkey", "p_size"))
         .otherwise(F.col("p_partkey").cast("string")).alias("pid"),
        F.when(sec, F.concat(F.col("p_name"), F.lit(" (Section "), F.col("p_brand"),
                             F.lit(" by section "), F.col("p_type"), F.lit(")")))
         .otherwise(F.col("p_name")).alias("pname"))
    return dims.extract_sections(t, "pid", "pname")


# ==== keys and merge (B9, B10) ===============================================================

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("dense_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
       ROW_NUMBER() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)
         AS line_id
FROM lineitem
""")
def dense_key_lines(spark, d):
    li = load(spark, d, "lineitem").select(*LINE_ORDER)
    return dense_key(li, LINE_ORDER, "line_id")


@register("dense_key_nulls", """
SELECT o_orderkey, prio, o_orderdate,
       1000 + ROW_NUMBER() OVER (ORDER BY prio NULLS FIRST, o_orderdate, o_orderkey) AS order_id
FROM (SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS prio, o_orderdate FROM orders)
""")
def dense_key_nulls(spark, d):
    o = load(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("prio"), "o_orderdate")
    return dense_key(o, ["prio", "o_orderdate", "o_orderkey"], "order_id", start=1000)


_MERGE_CUST_SQL = """
WITH src AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'FURNITURE') AS segment FROM customer),
ex AS (SELECT ROW_NUMBER() OVER (ORDER BY c_name NULLS FIRST, segment NULLS FIRST) AS cust_id,
              c_name, segment
       FROM src WHERE c_custkey % 2 = 0),
mx AS (SELECT coalesce(max(cust_id), 0) AS m FROM ex),
nw AS (SELECT DISTINCT c_name, segment FROM src s
       WHERE NOT EXISTS (SELECT 1 FROM ex e WHERE e.c_name IS NOT DISTINCT FROM s.c_name
                                            AND e.segment IS NOT DISTINCT FROM s.segment))
SELECT cust_id, c_name, segment FROM ex
UNION ALL
SELECT mx.m + ROW_NUMBER() OVER (ORDER BY c_name NULLS FIRST, segment NULLS FIRST) AS cust_id,
       c_name, segment
FROM nw, mx
"""


def _customer_merge_inputs(spark, d):
    src = load(spark, d, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"))
    existing = dense_key(src.where(F.col("c_custkey") % 2 == 0).select("c_name", "segment"),
                         ["c_name", "segment"], "cust_id").select("cust_id", "c_name", "segment")
    return existing, src.select("c_name", "segment")


@register("merge_new_rows", _MERGE_CUST_SQL)
def merge_customers(spark, d):
    existing, batch = _customer_merge_inputs(spark, d)
    return merge_new_rows(existing, batch, ["c_name", "segment"], "cust_id")


@register("merge_twice", _MERGE_CUST_SQL)
def merge_customers_twice(spark, d):
    existing, batch = _customer_merge_inputs(spark, d)
    once = merge_new_rows(existing, batch, ["c_name", "segment"], "cust_id")
    return merge_new_rows(once, batch, ["c_name", "segment"], "cust_id")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@register("merge_lineitem", """
WITH src AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem),
ex AS (SELECT ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                          l_shipdate) AS line_id, *
       FROM src WHERE l_orderkey % 2 = 0),
mx AS (SELECT coalesce(max(line_id), 0) AS m FROM ex),
nw AS (SELECT * FROM src s WHERE NOT EXISTS (
         SELECT 1 FROM ex e WHERE e.l_orderkey = s.l_orderkey AND e.l_linenumber = s.l_linenumber
           AND e.l_partkey = s.l_partkey AND e.l_suppkey = s.l_suppkey
           AND e.l_shipdate = s.l_shipdate))
SELECT line_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM ex
UNION ALL
SELECT mx.m + ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                          l_shipdate) AS line_id,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
FROM nw, mx
""")
def merge_lineitem(spark, d):
    src = load(spark, d, "lineitem").select(*LINE_KEY)
    existing = dense_key(src.where(F.col("l_orderkey") % 2 == 0), LINE_KEY, "line_id")
    existing = existing.select("line_id", *LINE_KEY)
    return merge_new_rows(existing, src, LINE_KEY, "line_id")


# ==== dimensions (B11-B13) ===================================================================

@register("dim_single", """
SELECT ROW_NUMBER() OVER (ORDER BY segment) AS segment_id, segment
FROM (SELECT DISTINCT coalesce(nullif(trim(nullif(c_mktsegment, 'FURNITURE')), ''), 'ND')
        AS segment FROM customer)
""")
def dim_single(spark, d):
    c = load(spark, d, "customer").select(F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("s"))
    return dims.dim_from_column(c, "s", "segment", "segment_id")


WORDS_SQL = """
SELECT ROW_NUMBER() OVER (ORDER BY word) AS word_id, word
FROM (SELECT DISTINCT trim(unnest(string_split(p_name, ' '))) AS word FROM part)
WHERE word <> ''
"""


@register("dim_list", WORDS_SQL)
def dim_list(spark, d):
    return dims.dim_from_list(load(spark, d, "part"), "p_name", "word", "word_id", sep=" ",
                              strip_notes=False)


@register("dim_list_notes", f"""
SELECT ROW_NUMBER() OVER (ORDER BY value) AS item_id, value
FROM (SELECT DISTINCT trim(regexp_replace(trim(unnest(regexp_extract_all({NOTED_LIST_SQL},
                          '(?:[^,(]|\\([^)]*\\))+'))), '\\([^)]*\\)', '', 'g')) AS value
      FROM part)
WHERE value <> ''
""")
def dim_list_notes(spark, d):
    return dims.dim_from_list(load(spark, d, "part"), _noted_list(), "value", "item_id")


@register("dim_multi", """
SELECT ROW_NUMBER() OVER (ORDER BY term) AS term_id, term
FROM (SELECT DISTINCT trim(unnest(regexp_extract_all(p_type || ',' || replace(p_name, ' ', ', '),
                                                     '(?:[^,(]|\\([^)]*\\))+'))) AS term
      FROM part)
WHERE term <> ''
""")
def dim_multi(spark, d):
    p = load(spark, d, "part")
    return dims.dim_from_columns(p, [F.col("p_type"), F.regexp_replace("p_name", " ", ", ")],
                                 "term", "term_id")


# ==== facts and bridges (B20, B25) ===========================================================

@register("lookup", """
WITH dim AS (SELECT ROW_NUMBER() OVER (ORDER BY p) AS priority_id, p
             FROM (SELECT DISTINCT coalesce(nullif(trim(o_orderpriority), ''), 'ND') AS p
                   FROM orders))
SELECT o.o_orderkey, d.priority_id
FROM orders o LEFT JOIN dim d ON trim(o.o_orderpriority) = d.p
""")
def lookup(spark, d):
    o = load(spark, d, "orders")
    dim = dims.dim_from_column(o, "o_orderpriority", "priority", "priority_id")
    return facts.lookup(o.select("o_orderkey", "o_orderpriority"), dim,
                        F.trim("o_orderpriority"), "priority", "priority_id",
                        broadcast_max_rows=100_000).select("o_orderkey", "priority_id")


@register("lookup_two_roles", f"""
WITH v AS ({WORDS_SQL})
SELECT p.p_partkey, a.word_id AS first_word_id, b.word_id AS second_word_id
FROM part p LEFT JOIN v a ON split_part(p.p_name, ' ', 1) = a.word
            LEFT JOIN v b ON split_part(p.p_name, ' ', 2) = b.word
""")
def lookup_two_roles(spark, d):
    p = load(spark, d, "part")
    words = dim_list(spark, d)
    parts = F.split("p_name", " ")
    f = facts.build_fact(p, [
        dict(dim=words, on=F.get(parts, 0), dim_name="word", dim_key="word_id",
             as_="first_word_id"),
        dict(dim=words, on=F.get(parts, 1), dim_name="word", dim_key="word_id",
             as_="second_word_id")])
    return f.select("p_partkey", "first_word_id", "second_word_id")


_BRIDGE_LIST_SQL = "replace(p_name, ' ', ', ') || ' (' || p_size || ', ' || p_brand || ')'"


@register("bridge", f"""
WITH v AS ({WORDS_SQL}),
i AS (SELECT p_partkey, trim(unnest(regexp_extract_all({_BRIDGE_LIST_SQL},
                                    '(?:[^,(]|\\([^)]*\\))+'))) AS item FROM part),
n AS (SELECT p_partkey, trim(regexp_replace(item, '\\([^)]*\\)', '', 'g')) AS value,
             trim(regexp_extract(item, '\\(([^)]*)\\)', 1)) AS Obs FROM i),
b AS (SELECT n.p_partkey, v.word_id, n.Obs FROM n LEFT JOIN v ON n.value = v.word
      WHERE n.value <> '')
SELECT ROW_NUMBER() OVER (ORDER BY p_partkey, word_id NULLS FIRST, Obs) AS bridge_id,
       p_partkey, word_id, Obs
FROM b
""")
def bridge(spark, d):
    p = load(spark, d, "part")
    words = dim_list(spark, d)
    listed = F.concat(F.regexp_replace("p_name", " ", ", "), F.lit(" ("),
                      F.col("p_size").cast("string"), F.lit(", "), F.col("p_brand"), F.lit(")"))
    return facts.bridge(p.withColumn("cell", listed), "p_partkey", "cell", words, "word",
                        "word_id", note="Obs", key="bridge_id")


# ==== audit (B21) ===========================================================================

AUDIT_SPECS = [
    TableSpec("orders", primary_key=("o_orderkey",), not_null=("o_orderkey", "o_custkey"),
              foreign_keys=(fk("o_custkey", "customer", "c_custkey"),)),
    TableSpec("lineitem", primary_key=("l_orderkey", "l_linenumber"),
              not_null=("l_orderkey", "l_partkey"),
              foreign_keys=(fk("l_orderkey", "orders", "o_orderkey"),
                            fk("l_partkey", "part", "p_partkey"))),
    TableSpec("customer", primary_key=("c_custkey",), not_null=("c_custkey", "c_mktsegment"),
              max_length={"c_name": 17, "c_mktsegment": 9}),
    TableSpec("part", primary_key=("p_partkey",)),
]


@register("audit", """
WITH o AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey)
           FROM orders),
c AS (SELECT CASE WHEN c_nationkey = 3 THEN -c_custkey - 1 ELSE c_custkey END AS c_custkey, c_name,
             nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment FROM customer),
l AS (SELECT * FROM lineitem)
SELECT 'orders' AS table_name, 'primary_key_duplicates' AS check_name,
       'o_orderkey' AS column_name,
       coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM o GROUP BY o_orderkey
                                     HAVING count(*) > 1)), 0) AS violations
UNION ALL SELECT 'orders', 'not_null', 'o_orderkey', (SELECT count(*) FROM o WHERE o_orderkey IS NULL)
UNION ALL SELECT 'orders', 'not_null', 'o_custkey', (SELECT count(*) FROM o WHERE o_custkey IS NULL)
UNION ALL SELECT 'orders', 'foreign_key_orphans', 'o_custkey',
       (SELECT count(*) FROM o WHERE o_custkey IS NOT NULL
          AND o_custkey NOT IN (SELECT c_custkey FROM c WHERE c_custkey IS NOT NULL))
UNION ALL SELECT 'lineitem', 'primary_key_duplicates', 'l_orderkey,l_linenumber',
       coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM l GROUP BY l_orderkey, l_linenumber
                                     HAVING count(*) > 1)), 0)
UNION ALL SELECT 'lineitem', 'not_null', 'l_orderkey', (SELECT count(*) FROM l WHERE l_orderkey IS NULL)
UNION ALL SELECT 'lineitem', 'not_null', 'l_partkey', (SELECT count(*) FROM l WHERE l_partkey IS NULL)
UNION ALL SELECT 'lineitem', 'foreign_key_orphans', 'l_orderkey',
       (SELECT count(*) FROM l WHERE l_orderkey IS NOT NULL
          AND l_orderkey NOT IN (SELECT o_orderkey FROM o WHERE o_orderkey IS NOT NULL))
UNION ALL SELECT 'lineitem', 'foreign_key_orphans', 'l_partkey',
       (SELECT count(*) FROM l WHERE l_partkey IS NOT NULL
          AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL))
UNION ALL SELECT 'customer', 'primary_key_duplicates', 'c_custkey',
       coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM c GROUP BY c_custkey
                                     HAVING count(*) > 1)), 0)
UNION ALL SELECT 'customer', 'not_null', 'c_custkey', (SELECT count(*) FROM c WHERE c_custkey IS NULL)
UNION ALL SELECT 'customer', 'not_null', 'c_mktsegment',
       (SELECT count(*) FROM c WHERE c_mktsegment IS NULL)
UNION ALL SELECT 'customer', 'max_length', 'c_name', (SELECT count(*) FROM c WHERE length(c_name) > 17)
UNION ALL SELECT 'customer', 'max_length', 'c_mktsegment',
       (SELECT count(*) FROM c WHERE length(c_mktsegment) > 9)
UNION ALL SELECT 'part', 'primary_key_duplicates', 'p_partkey',
       coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM part GROUP BY p_partkey
                                     HAVING count(*) > 1)), 0)
""")
def audit_tables(spark, d):
    tables = {
        "orders": load(spark, d, "orders").withColumn("o_orderkey", F.when(
            F.col("o_orderstatus") == "F", -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey"))),
        "customer": load(spark, d, "customer").select(
            F.when(F.col("c_nationkey") == 3, -F.col("c_custkey") - 1).otherwise(F.col("c_custkey")).alias("c_custkey"),
            "c_name",
            F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("c_mktsegment")),
        "lineitem": load(spark, d, "lineitem"),
        "part": load(spark, d, "part"),
    }
    return audit(tables, AUDIT_SPECS)


# ==== the same operators on the text tables ================================================

@register("q1_conversations_per_role", """
SELECT role, COUNT(*) AS qty FROM (SELECT DISTINCT role, conv_id FROM conversations) GROUP BY role
""")
def q1_conversations(spark, d):
    return reports.count_distinct_by(load(spark, d, "conversations"), "role", "conv_id", "qty")


@register("q4_rank_sources", """
SELECT ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, source ASC NULLS LAST) AS Top,
       source AS TopActivities, COUNT(*) AS n
FROM documents GROUP BY source
""")
def q4_sources(spark, d):
    docs = load(spark, d, "documents")
    vocab = dims.dim_from_column(docs, "source", "source_name", "source_id")
    fact = facts.lookup(docs.select("doc_id", "source"), vocab, F.trim("source"), "source_name",
                        "source_id")
    return reports.rank_by_frequency(fact, "source_id", vocab, "source_id", "source_name", "Top",
                                     "TopActivities", count_name="n")


@register("q5_lang_by_source", """
SELECT source, lang, COUNT(*) AS total FROM documents GROUP BY source, lang
""")
def q5_langs(spark, d):
    docs = load(spark, d, "documents")
    langs = dims.dim_from_column(docs, "lang", "lang", "lang_id")
    fact = facts.lookup(docs, langs, F.trim("lang"), "lang", "lang_id")
    return reports.count_by_attribute(fact, "source", "lang_id", "total", attr_dim=langs,
                                      attr_dim_key="lang_id", attr_cols=["lang"],
                                      keep_attr_key=False)


@register("clean_conversations", r"""
SELECT conv_id, turn, role,
       coalesce(nullif(trim(regexp_replace(text, '[^a-zA-Z0-9 \t\n\r\f#(),:]', '', 'g')), ''),
                'ND') AS clean_text
FROM conversations
""")
def clean_conversations(spark, d):
    c = load(spark, d, "conversations").select("conv_id", "turn", "role",
                                                F.col("text").alias("clean_text"))
    return X.clean_text(c, {"clean_text": (X.KEEP_TEXT, "", X.MISSING)})


@register("audit_labels", """
WITH d AS (SELECT CASE WHEN lang = 'de' THEN -doc_id - 1 ELSE doc_id END AS doc_id FROM documents)
SELECT 'labels' AS table_name, 'primary_key_duplicates' AS check_name, 'doc_id' AS column_name,
       coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM labels GROUP BY doc_id
                                     HAVING count(*) > 1)), 0) AS violations
UNION ALL SELECT 'labels', 'not_null', 'quality', (SELECT count(*) FROM labels WHERE quality IS NULL)
UNION ALL SELECT 'labels', 'not_null', 'toxic', (SELECT count(*) FROM labels WHERE toxic IS NULL)
UNION ALL SELECT 'labels', 'foreign_key_orphans', 'doc_id',
       (SELECT count(*) FROM labels WHERE doc_id IS NOT NULL
          AND doc_id NOT IN (SELECT doc_id FROM d WHERE doc_id IS NOT NULL))
""")
def audit_labels(spark, d):
    tables = {"labels": load(spark, d, "labels"),
              "documents": load(spark, d, "documents").select(
                  F.when(F.col("lang") == "de", -F.col("doc_id") - 1).otherwise(F.col("doc_id")).alias("doc_id"))}
    spec = TableSpec("labels", primary_key=("doc_id",), not_null=("quality", "toxic"),
                     foreign_keys=(fk("doc_id", "documents"),))
    return audit(tables, [spec])


# ==== end-to-end pipeline (B24) on survey-shaped data derived from the tables ================

def _tables(spark, d, only=None, keyed=True):
    """The survey tables of ``only`` (and those they refer to), built afresh from the folder."""
    from tidyspark.plans.pipeline import survey_inputs
    from tidyspark.plans.survey import normalize_survey
    visits, sightings = survey_inputs(spark, d)
    return normalize_survey(spark, normalize_headers(visits), normalize_headers(sightings), only=only,
                            keyed=keyed)


def _report(spark, d, name):
    from tidyspark.plans.survey import REPORT_TABLES, survey_report
    return survey_report(_tables(spark, d, REPORT_TABLES[name], keyed=False), name)


@register("pipeline_q1", """
WITH q AS (SELECT DISTINCT s.s_nationkey AS ParkID, 'S-' || l.l_partkey AS SquirrelID
           FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
pk AS (SELECT DISTINCT n.n_nationkey AS ParkID,
              regexp_replace(array_to_string(list_transform(string_split(lower(n.n_name), ' '),
                              lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') || ' Park',
                             '[^a-zA-Z0-9 \t\n\r\f#(),:]', '', 'g') AS ParkName
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT q.ParkID, pk.ParkName, COUNT(*) AS qty_squirrel
FROM q LEFT JOIN pk ON q.ParkID = pk.ParkID
GROUP BY q.ParkID, pk.ParkName
""")
def pipeline_q1(spark, d):
    return _report(spark, d, "query_1")


@register("pipeline_q2", """
WITH sight AS (SELECT DISTINCT s.s_nationkey AS ParkID, 'S-' || l.l_partkey AS SquirrelID
               FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
area_src AS (
  SELECT DISTINCT n.n_nationkey AS ParkID,
         regexp_replace(upper(r.r_name), '[^a-zA-Z0-9 \t\n\r\f#(),:]', '', 'g') AS AreaName,
         regexp_replace(left(r.r_name, 1), '[^a-zA-Z0-9 \t\n\r\f#(),:]', '', 'g') AS Area_ID
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
areas AS (SELECT ROW_NUMBER() OVER (ORDER BY AreaName, Area_ID) AS AreaID, AreaName, Area_ID
          FROM (SELECT DISTINCT AreaName, Area_ID FROM area_src)),
parks AS (SELECT a.ParkID, ar.AreaID FROM area_src a
          JOIN areas ar ON a.AreaName = ar.AreaName AND a.Area_ID = ar.Area_ID)
SELECT q.AreaID, ar.AreaName, COUNT(*) AS qty_squirrel
FROM (SELECT DISTINCT p.AreaID, s.SquirrelID FROM sight s LEFT JOIN parks p ON s.ParkID = p.ParkID) q
LEFT JOIN areas ar ON q.AreaID = ar.AreaID
GROUP BY q.AreaID, ar.AreaName
""")
def pipeline_q2(spark, d):
    return _report(spark, d, "query_2")


@register("pipeline_q3", """
WITH v AS (
  SELECT o.*, c.c_mktsegment, n.n_nationkey, n.n_name,
         o.o_orderdate + to_hours(CAST(12 + o.o_custkey % 11 AS BIGINT))
                       + to_minutes(CAST(o.o_orderkey % 60 AS BIGINT)) AS st,
         CAST(o.o_orderkey % 90 + 10 AS BIGINT) AS mins
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
status AS (
  SELECT n_nationkey AS ParkID,
         CASE WHEN o_orderstatus = 'P' THEN CAST(left(o_orderpriority, 1) AS INTEGER) END AS sec,
         CAST(o_orderdate AS DATE) AS d, strftime(st, '%H:%M:%S') AS t0,
         strftime(st + to_minutes(mins), '%H:%M:%S') AS t1, mins AS total,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'Full'
              WHEN o_orderpriority LIKE '2%' THEN 'Lovely  warden'
              ELSE substr(o_orderpriority, 3) END AS cond,
         CASE WHEN o_orderpriority LIKE '1%' THEN lower(c_mktsegment) || ' outing' ELSE '' END
           AS cond_obs,
         CASE WHEN o_orderstatus = 'O' THEN 'Little' WHEN o_orderstatus = 'F' THEN 'ND'
              ELSE 'Nothing' END AS litter,
         CASE WHEN o_orderstatus = 'O' THEN 'near the gate' ELSE '' END AS litter_obs,
         CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE o_orderkey % 40 + 30 END AS temp,
         [struct_pack(a := 'Geese', n := ''),
          struct_pack(a := upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)),
                      n := (o_custkey % 4) || ', asleep'),
          struct_pack(a := regexp_replace(
                              array_to_string(list_transform(string_split(lower(n_name), ' '),
                                  lambda w: upper(left(w, 1)) || substr(w, 2)), ' '),
                              '[^a-zA-Z0-9 \t\n\r\f#(),:]', '', 'g') || ' Birds',
                      n := '')] AS animals
  FROM v),
b AS (SELECT DISTINCT ParkID, sec, d, t0, t1, total, cond, cond_obs, litter, litter_obs, temp,
             unnest(animals, recursive := true)
      FROM status),
pk AS (SELECT DISTINCT n_nationkey AS ParkID,
              regexp_replace(array_to_string(list_transform(string_split(lower(n_name), ' '),
                              lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') || ' Park',
                             '[^a-zA-Z0-9 \t\n\r\f#(),:]', '', 'g') AS ParkName
       FROM v)
SELECT pk.ParkName, b.a AS AnimalName, COUNT(*) AS Total
FROM b LEFT JOIN pk ON b.ParkID = pk.ParkID
GROUP BY b.ParkID, pk.ParkName, b.a
""")
def pipeline_q3(spark, d):
    return _report(spark, d, "query_3")


@register("pipeline_q4", """
WITH sight AS (
  SELECT 'S-' || l.l_partkey AS SquirrelID, s.s_nationkey AS ParkID,
         upper(left(p.p_type, 1)) || lower(substr(p.p_type, 2)) AS prim,
         upper(left(string_split(p.p_name, ' ')[1], 1))
           || lower(substr(string_split(p.p_name, ' ')[1], 2)) AS high,
         p.p_brand AS notes, 40.7 + l.l_extendedprice / 1e6 AS lat, -73.9 - l.l_discount AS lon,
         CASE WHEN l.l_returnflag = 'R' THEN 0
              WHEN l.l_returnflag = 'A' THEN p.p_size END AS min_h,
         CASE WHEN l.l_returnflag IN ('R', 'A') THEN
              CASE WHEN l.l_returnflag = 'R' THEN p.p_size ELSE p.p_size + 5 END END AS max_h,
         list_transform(string_split(p.p_name, ' '),
                        lambda w: upper(left(w, 1)) || lower(substr(w, 2))) AS words,
         CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS qty
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
items AS (
  SELECT DISTINCT SquirrelID, ParkID, prim, high, notes, lat, lon, min_h, max_h,
         words[i] AS value, CASE WHEN i = len(words) THEN qty ELSE '' END AS note
  FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM sight))
SELECT ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, value ASC NULLS LAST) AS Top,
       value AS TopActivities
FROM items GROUP BY value
""")
def pipeline_q4(spark, d):
    return _report(spark, d, "query_4")


@register("pipeline_q5", """
WITH sight AS (
  SELECT DISTINCT
         'S-' || l.l_partkey AS SquirrelID,
         s.s_nationkey AS ParkID,
         upper(left(p.p_type, 1)) || lower(substr(p.p_type, 2)) AS prim,
         upper(left(string_split(p.p_name, ' ')[1], 1))
           || lower(substr(string_split(p.p_name, ' ')[1], 2)) AS high,
         p.p_brand AS notes,
         40.7 + l.l_extendedprice / 1e6 AS lat,
         -73.9 - l.l_discount AS lon,
         CASE WHEN l.l_returnflag = 'R' THEN 0
              WHEN l.l_returnflag = 'A' THEN p.p_size END AS min_h,
         CASE WHEN l.l_returnflag IN ('R', 'A') THEN
              CASE WHEN l.l_returnflag = 'R' THEN p.p_size ELSE p.p_size + 5 END END AS max_h
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
pk AS (SELECT DISTINCT n.n_nationkey AS ParkID,
              regexp_replace(array_to_string(list_transform(string_split(lower(n.n_name), ' '),
                              lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') || ' Park',
                             '[^a-zA-Z0-9 \t\n\r\f#(),:]', '', 'g') AS ParkName
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT sight.ParkID, pk.ParkName, sight.prim AS PrimaryFurColors, COUNT(*) AS Total
FROM sight LEFT JOIN pk ON sight.ParkID = pk.ParkID
GROUP BY sight.ParkID, pk.ParkName, sight.prim
""")
def pipeline_q5(spark, d):
    return _report(spark, d, "query_5")


# -- every table of the pipeline, keys included ----------------------------------------------

_INITCAP = "array_to_string(list_transform(string_split(lower({0}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"
_CLEAN = "regexp_replace({0}, '[^a-zA-Z0-9 \\t\\n\\r\\f#(),:]', '', 'g')"

_SURVEY_SQL = f"""
WITH v0 AS (
  SELECT o.*, c.c_mktsegment, n.n_nationkey, n.n_name, r.r_name, o.o_orderstatus = 'P' AS sectioned,
         o.o_orderdate + to_hours(CAST(12 + o.o_custkey % 11 AS BIGINT))
                       + to_minutes(CAST(o.o_orderkey % 60 AS BIGINT)) AS st,
         CAST(o.o_orderkey % 90 + 10 AS BIGINT) AS mins
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
v AS (
  SELECT n_nationkey AS ParkID, upper(r_name) AS AreaName, left(r_name, 1) AS Area_ID,
         {_CLEAN.format(_INITCAP.format("n_name"))} || ' Park' AS ParkName,
         CASE WHEN sectioned THEN CAST(left(o_orderpriority, 1) AS BIGINT) END AS SectionID,
         CASE WHEN sectioned THEN {_INITCAP.format("substr(o_orderpriority, 3, 20)")} END AS ParkSectionName,
         CAST(o_orderdate AS DATE) AS "Date", strftime(st, '%H:%M:%S') AS StartTime,
         strftime(st + to_minutes(mins), '%H:%M:%S') AS EndTime, CAST(mins AS INTEGER) AS TotalTime,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'Full' WHEN o_orderpriority LIKE '2%' THEN 'Lovely  warden'
              ELSE substr(o_orderpriority, 3) END AS ParkConditionName,
         CASE WHEN o_orderpriority LIKE '1%' THEN lower(c_mktsegment) || ' outing' ELSE '' END AS ConditionsObs,
         CASE WHEN o_orderstatus = 'O' THEN 'Little' WHEN o_orderstatus = 'F' THEN 'ND' ELSE 'Nothing' END
           AS ParkLitterName,
         CASE WHEN o_orderstatus = 'O' THEN 'near the gate' ELSE '' END AS LitterObs,
         CASE WHEN o_orderpriority NOT LIKE '5%' THEN CAST(o_orderkey % 40 + 30 AS INTEGER) END AS TemperatureDegrees,
         CASE WHEN o_orderpriority LIKE '5%' THEN ['damp', 'dim'] WHEN o_orderpriority LIKE '4%' THEN ['ND']
              ELSE [lower(o_orderstatus), 'misty', 'hazy'] END AS weathers,
         CASE WHEN o_orderpriority LIKE '5%' THEN '' WHEN o_orderpriority LIKE '4%' THEN 'but hazy'
              ELSE 'with showers' END AS WeatherObs,
         [struct_pack(item := 'Geese', note := ''),
          struct_pack(item := {_INITCAP.format("c_mktsegment")}, note := (o_custkey % 4) || ', asleep'),
          struct_pack(item := {_CLEAN.format(_INITCAP.format("n_name"))} || ' Birds', note := '')] AS animals
  FROM v0),
s AS (
  SELECT 'S-' || l.l_partkey AS SquirrelID, s.s_nationkey AS ParkID, {_INITCAP.format("p.p_type")} AS prim,
         list_transform(string_split(p.p_name, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))) AS words,
         p.p_brand AS SquirrelColorNotes, 'ND' AS SquirrelSpecificLocation, 'ND' AS SquirrelObservations,
         40.7 + l.l_extendedprice / 1e6 AS SquirrelLatitude, -73.9 - l.l_discount AS SquirrelLongitude,
         CASE WHEN l.l_returnflag = 'R' THEN 0 WHEN l.l_returnflag = 'A' THEN p.p_size END AS SquirrelMinHeightFeet,
         CASE WHEN l.l_returnflag = 'R' THEN p.p_size WHEN l.l_returnflag = 'A' THEN p.p_size + 5 END
           AS SquirrelMaxHeightFeet,
         CASE WHEN l.l_linestatus = 'O' THEN 'Low Wall' ELSE 'Up High' END AS place,
         CASE WHEN l.l_linestatus = 'O' THEN '' ELSE 'roof, gutter' END AS place_note,
         CASE WHEN l.l_discount > 0.05 THEN ['Curious', 'Begs'] ELSE ['Flees'] END AS meets,
         CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS qty
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
areas AS (SELECT row_number() OVER (ORDER BY AreaName, Area_ID) AS AreaID, AreaName, Area_ID
          FROM (SELECT DISTINCT AreaName, Area_ID FROM v)),
parks AS (SELECT DISTINCT v.ParkID, a.AreaID, v.ParkName FROM v JOIN areas a USING (AreaName, Area_ID)),
parksections AS (
  SELECT row_number() OVER (ORDER BY ParkID, SectionID, ParkSectionName) AS ParkSectionID, *
  FROM (SELECT DISTINCT ParkID, SectionID, ParkSectionName FROM v WHERE ParkSectionName IS NOT NULL)),
parkconditions AS (SELECT row_number() OVER (ORDER BY ParkConditionName) AS ParkConditionID, ParkConditionName
                   FROM (SELECT DISTINCT ParkConditionName FROM v)),
parklitters AS (SELECT row_number() OVER (ORDER BY ParkLitterName) AS ParkLitterID, ParkLitterName
                FROM (SELECT DISTINCT ParkLitterName FROM v)),
animals AS (SELECT row_number() OVER (ORDER BY AnimalName) AS AnimalID, AnimalName
            FROM (SELECT DISTINCT a.item AS AnimalName FROM (SELECT unnest(animals) AS a FROM v))),
weathers AS (SELECT row_number() OVER (ORDER BY WeatherName) AS WeatherID, WeatherName
             FROM (SELECT DISTINCT unnest(weathers) AS WeatherName FROM v)),
status_rows AS (
  SELECT v.*, p.ParkSectionID, c.ParkConditionID, l.ParkLitterID FROM v
  LEFT JOIN parksections p ON p.ParkID = v.ParkID AND p.SectionID = v.SectionID
                          AND p.ParkSectionName = v.ParkSectionName
  JOIN parkconditions c USING (ParkConditionName) JOIN parklitters l USING (ParkLitterName)),
numbered_status AS (
  SELECT *, dense_rank() OVER (ORDER BY ParkID NULLS FIRST, ParkSectionID NULLS FIRST, "Date" NULLS FIRST, StartTime,
                               EndTime, TotalTime, ParkConditionID, ConditionsObs, ParkLitterID, LitterObs,
                               TemperatureDegrees NULLS FIRST) AS ParkStatusID
  FROM status_rows),
parkstatus AS (
  SELECT DISTINCT ParkStatusID, ParkID, ParkSectionID, "Date", StartTime, EndTime, TotalTime, ParkConditionID,
         ConditionsObs, ParkLitterID, LitterObs, TemperatureDegrees FROM numbered_status),
parkstatuswheater AS (
  SELECT row_number() OVER (ORDER BY ParkStatusID, WeatherID, WeatherObs) AS ParkStatusWheaterID, *
  FROM (SELECT DISTINCT ParkStatusID, WeatherID, WeatherObs
        FROM (SELECT ParkStatusID, WeatherObs, unnest(weathers) AS WeatherName FROM numbered_status)
        JOIN weathers USING (WeatherName))),
parkstatusanimals AS (
  SELECT row_number() OVER (ORDER BY ParkStatusID, AnimalID, ParkStatusAnimalObs) AS ParkStatusAnimalID, *
  FROM (SELECT DISTINCT ParkStatusID, AnimalID, a.note AS ParkStatusAnimalObs
        FROM (SELECT ParkStatusID, unnest(animals) AS a FROM numbered_status) JOIN animals ON AnimalName = a.item)),
colors AS (SELECT row_number() OVER (ORDER BY ColorName) AS ColorID, ColorName
           FROM (SELECT prim AS ColorName FROM s UNION SELECT unnest(words) FROM s)),
locations AS (SELECT row_number() OVER (ORDER BY LocationName) AS LocationID, LocationName
              FROM (SELECT DISTINCT place AS LocationName FROM s)),
activities AS (SELECT row_number() OVER (ORDER BY ActivityName) AS ActivityID, ActivityName
               FROM (SELECT DISTINCT unnest(words) AS ActivityName FROM s)),
interactions AS (SELECT row_number() OVER (ORDER BY InteractionName) AS InteractionID, InteractionName
                 FROM (SELECT DISTINCT unnest(meets) AS InteractionName FROM s)),
numbered_sights AS (
  SELECT s.*, c1.ColorID AS SquirrelPrimFurColorID, c2.ColorID AS SquirrelHighFurColorID,
         dense_rank() OVER (ORDER BY SquirrelID, ParkID NULLS FIRST, c1.ColorID, c2.ColorID, SquirrelColorNotes,
                            SquirrelSpecificLocation, SquirrelObservations, SquirrelLatitude, SquirrelLongitude,
                            SquirrelMinHeightFeet NULLS FIRST, SquirrelMaxHeightFeet NULLS FIRST) AS SquirrelDataID
  FROM s JOIN colors c1 ON c1.ColorName = s.prim JOIN colors c2 ON c2.ColorName = s.words[1]),
squirrels AS (
  SELECT DISTINCT SquirrelDataID, SquirrelID, ParkID, SquirrelPrimFurColorID, SquirrelHighFurColorID,
         SquirrelColorNotes, SquirrelSpecificLocation, SquirrelObservations, SquirrelLatitude, SquirrelLongitude,
         SquirrelMinHeightFeet, SquirrelMaxHeightFeet FROM numbered_sights),
squirrelhighlights AS (
  SELECT row_number() OVER (ORDER BY SquirrelDataID, ColorID) AS SquirrelHighlightID, *
  FROM (SELECT DISTINCT SquirrelDataID, ColorID, '' AS SquirrelHighlightObs
        FROM (SELECT SquirrelDataID, unnest(words) AS ColorName FROM numbered_sights) JOIN colors USING (ColorName))),
squirrelactivities AS (
  SELECT row_number() OVER (ORDER BY SquirrelDataID, ActivityID, SquirrelActivityObs) AS SquirrelActivityID, *
  FROM (SELECT DISTINCT SquirrelDataID, ActivityID,
               CASE WHEN i = len(words) THEN qty ELSE '' END AS SquirrelActivityObs
        FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM numbered_sights)
        JOIN activities ON ActivityName = words[i])),
squirrellocations AS (
  SELECT row_number() OVER (ORDER BY SquirrelDataID, LocationID, SquirrelLocationObs) AS SquirrelLocationID, *
  FROM (SELECT DISTINCT SquirrelDataID, LocationID, place_note AS SquirrelLocationObs
        FROM numbered_sights JOIN locations ON LocationName = place)),
squirrelhumaninteractions AS (
  SELECT row_number() OVER (ORDER BY SquirrelDataID, InteractionID) AS SquirrelHumanInteractionID, *
  FROM (SELECT DISTINCT SquirrelDataID, InteractionID, '' AS SquirrelHumanInteractionObs
        FROM (SELECT SquirrelDataID, unnest(meets) AS InteractionName FROM numbered_sights)
        JOIN interactions USING (InteractionName)))
"""

for _name in ["areas", "parks", "parksections", "parkconditions", "parklitters", "animals", "weathers", "parkstatus",
              "parkstatuswheater", "parkstatusanimals", "colors", "locations", "activities", "interactions",
              "squirrels", "squirrelhighlights", "squirrelactivities", "squirrellocations",
              "squirrelhumaninteractions"]:
    register(f"pipeline_{_name}", f"{_SURVEY_SQL}SELECT * FROM {_name}")(
        lambda spark, d, name=_name: _tables(spark, d, {name})[name])


_AUDITED = ["parkstatus", "squirrels", "parksections", "areas", "parks", "colors", "parkconditions", "parklitters"]


@register("pipeline_audit", f"""{_SURVEY_SQL},
k AS (SELECT * FROM parks WHERE ParkID % 5 <> 3), c AS (SELECT * FROM colors WHERE ColorID % 4 <> 2)
SELECT * FROM (
  SELECT 'parks' AS table_name, 'foreign_key_orphans' AS check_name, 'AreaID' AS column_name, 0 AS violations
  UNION ALL SELECT 'parks', 'primary_key_duplicates', 'ParkID', 0
  UNION ALL SELECT 'parkstatus', 'foreign_key_orphans', 'ParkID',
    (SELECT count(*) FROM parkstatus WHERE ParkID NOT IN (SELECT ParkID FROM k))
  UNION ALL SELECT 'squirrels', 'foreign_key_orphans', 'ParkID',
    (SELECT count(*) FROM squirrels WHERE ParkID NOT IN (SELECT ParkID FROM k))
  UNION ALL SELECT 'parksections', 'foreign_key_orphans', 'ParkID',
    (SELECT count(*) FROM parksections WHERE ParkID NOT IN (SELECT ParkID FROM k))
  UNION ALL SELECT 'squirrels', 'foreign_key_orphans', 'SquirrelPrimFurColorID',
    (SELECT count(*) FROM squirrels WHERE SquirrelPrimFurColorID NOT IN (SELECT ColorID FROM c))
  UNION ALL SELECT 'squirrels', 'foreign_key_orphans', 'SquirrelHighFurColorID',
    (SELECT count(*) FROM squirrels WHERE SquirrelHighFurColorID NOT IN (SELECT ColorID FROM c))
  UNION ALL SELECT 'squirrels', 'not_null', 'SquirrelMinHeightFeet',
    (SELECT count(*) FROM squirrels WHERE SquirrelMinHeightFeet IS NULL)
  UNION ALL SELECT 'parkstatus', 'max_length', 'LitterObs',
    (SELECT count(*) FROM parkstatus WHERE length(LitterObs) > 10))
""")
def pipeline_audit(spark, d):
    """The audit over the pipeline's tables with every fifth park key and every fourth colour key changed."""
    t = _tables(spark, d, _AUDITED)
    moved = dict(t, parks=t["parks"].withColumn(
                     "ParkID", F.when(F.col("ParkID") % 5 == 3, -F.col("ParkID")).otherwise(F.col("ParkID"))),
                 colors=t["colors"].withColumn(
                     "ColorID", F.when(F.col("ColorID") % 4 == 2, -F.col("ColorID")).otherwise(F.col("ColorID"))))
    return audit(moved, [
        TableSpec("parks", primary_key=("ParkID",), foreign_keys=(fk("AreaID", "areas"),)),
        TableSpec("parksections", foreign_keys=(fk("ParkID", "parks"),)),
        TableSpec("parkstatus", foreign_keys=(fk("ParkID", "parks"),), max_length={"LitterObs": 10}),
        TableSpec("squirrels", not_null=("SquirrelMinHeightFeet",), foreign_keys=(
            fk("ParkID", "parks"), fk("SquirrelPrimFurColorID", "colors", "ColorID"),
            fk("SquirrelHighFurColorID", "colors", "ColorID")))])


# DuckDB sums BIGINT counts into HUGEINT; the audit reports counts as BIGINT
for _name in ("audit", "audit_labels", "pipeline_audit"):
    ORACLE[_name] = ("SELECT table_name, check_name, column_name, "
                     "CAST(violations AS BIGINT) AS violations FROM (" + ORACLE[_name] + ")")
