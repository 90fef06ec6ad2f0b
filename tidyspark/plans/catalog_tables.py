"""Registered queries of stored tables, damaged files, nested notes and skewed lookups, with their oracles.

As in ``catalog``: whole tables, the same composed text on both sides, equal column names.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.functions import parse as P
from tidyspark.operators import facts, reports
from tidyspark.operators.audit import audit
from tidyspark.operators.enforce import enforce
from tidyspark.operators.maintained import MaintainedCounts
from tidyspark.plans.catalog import load, register
from tidyspark.session import scratch_path
from tidyspark.sources.checked import read_csv_checked
from tidyspark.sources.store import StoredTable
from tidyspark.specs import TableSpec, fk

# ==== stored tables (B23, B10, U1, J6) ====================================================


def _customers(spark, d):
    return load(spark, d, "customer").select("c_custkey", "c_name",
                                             F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"))


_SOURCE_SQL = "src AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'FURNITURE') AS segment FROM customer)"


@register("store_replace", f"""
WITH {_SOURCE_SQL},
old AS (SELECT row_number() OVER (ORDER BY c_name NULLS FIRST, segment NULLS FIRST) AS cust_id, c_name, segment
        FROM (SELECT DISTINCT c_name, segment FROM src WHERE c_custkey % 2 = 0))
SELECT 'held' AS state, * FROM old
UNION ALL SELECT 'killed', * FROM old
UNION ALL SELECT 'replaced', c_custkey, c_name, segment FROM src WHERE c_custkey % 3 = 0
UNION ALL SELECT 'version 1', * FROM old
""")
def store_replace(spark, d):
    """A held frame, the table after a writer that ended before it published, after a replace, and by version."""
    src = _customers(spark, d)
    table = StoredTable(spark, scratch_path(spark, "store-replace"))
    table.merge(src.where("c_custkey % 2 = 0").select("c_name", "segment"), ["c_name", "segment"], "cust_id")
    new = src.where("c_custkey % 3 = 0").withColumnRenamed("c_custkey", "cust_id")
    held = table.read()

    class Killed(Exception):
        pass

    def killed():
        raise Killed
    try:
        table.replace(new, "cust_id", before_publish=killed)
    except Killed:
        pass
    after_kill = table.read()
    table.replace(new, "cust_id")
    states = {"held": held, "killed": after_kill, "replaced": table.read(), "version 1": table.read(1)}
    parts = [df.select(F.lit(state).alias("state"), "cust_id", "c_name", "segment") for state, df in states.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_CONCURRENT_SQL = f"""
WITH {_SOURCE_SQL},
ex AS (SELECT row_number() OVER (ORDER BY c_name NULLS FIRST, segment NULLS FIRST) AS cust_id, c_name, segment
       FROM (SELECT DISTINCT c_name, segment FROM src WHERE c_custkey % 6 = 0)),
won AS (SELECT (SELECT count(*) FROM ex)
               + row_number() OVER (ORDER BY c_name NULLS FIRST, segment NULLS FIRST) AS cust_id, c_name, segment
        FROM (SELECT DISTINCT c_name, segment FROM src WHERE c_custkey % 6 IN (0, 2, 3)
              EXCEPT SELECT c_name, segment FROM ex)),
lost AS (SELECT (SELECT count(*) FROM ex) + (SELECT count(*) FROM won)
                + row_number() OVER (ORDER BY c_name NULLS FIRST, segment NULLS FIRST) AS cust_id, c_name, segment
         FROM (SELECT DISTINCT c_name, segment FROM src WHERE c_custkey % 6 IN (0, 1, 2)
               EXCEPT SELECT c_name, segment FROM ex EXCEPT SELECT c_name, segment FROM won))
SELECT * FROM ex UNION ALL SELECT * FROM won UNION ALL SELECT * FROM lost
"""


def _concurrent(spark, d, buckets):
    src, path = _customers(spark, d), scratch_path(spark, "store-concurrent")

    def merge(rests, **kw):
        rows = src.where(F.col("c_custkey") % 6 == rests[0])
        for r in rests[1:]:
            rows = rows.unionByName(src.where(F.col("c_custkey") % 6 == r))
        return StoredTable(spark, path, buckets).merge(rows.select("c_name", "segment"), ["c_name", "segment"],
                                                       "cust_id", **kw)
    merge([0])
    # the second merge starts from the same state and publishes before the first one does
    merge([0, 1, 2], before_publish=lambda: merge([0, 2, 3]))
    return StoredTable(spark, path).read()


@register("store_concurrent_merges", _CONCURRENT_SQL)
def store_concurrent_merges(spark, d):
    return _concurrent(spark, d, 0)


@register("store_concurrent_merges_buckets", _CONCURRENT_SQL)
def store_concurrent_merges_buckets(spark, d):
    return _concurrent(spark, d, 8)


@register("store_replayed_batches", """
WITH b AS (SELECT DISTINCT o_custkey, o_orderkey % 3 AS part FROM orders),
first AS (SELECT o_custkey, min(part) AS part FROM b GROUP BY o_custkey)
SELECT row_number() OVER (ORDER BY part, o_custkey) AS id, o_custkey FROM first
""")
def store_replayed_batches(spark, d):
    """Three numbered batches, each of which comes twice; the second time with rows that must not be seen."""
    orders = load(spark, d, "orders")
    table = StoredTable(spark, scratch_path(spark, "store-replayed"), buckets=4)
    for number in range(3):
        batch = orders.where(F.col("o_orderkey") % 3 == number).select("o_custkey")
        table.merge(batch, "o_custkey", "id", sequence="orders", batch_number=number)
        table.merge(batch.select(-F.col("o_custkey").alias("o_custkey")), "o_custkey", "id", sequence="orders",
                    batch_number=number)
    return table.read()


# ==== damaged files (S1, S10) ==============================================================

_CSV_SQL = """
t AS (SELECT c_custkey, '"' || replace(c_name, '#', '""') || '"' AS name, CAST(c_nationkey AS VARCHAR) AS nation,
             c_mktsegment AS segment FROM customer),
lines AS (SELECT *, CASE c_custkey % 10
    WHEN 1 THEN c_custkey || ',' || name || ',' || nation || ',' || segment || ',LOST'
    WHEN 2 THEN c_custkey || ',' || name || ',' || nation
    WHEN 3 THEN c_custkey || ',"open,' || nation || ',' || segment
    WHEN 4 THEN c_custkey || ',' || name || ',n' || nation || ',' || segment
    WHEN 5 THEN c_custkey || ',,' || nation || ',""'
    ELSE c_custkey || ',' || name || ',' || nation || ',' || segment END AS raw FROM t)
"""


def _damaged_csv(spark, d):
    c = load(spark, d, "customer")
    name = F.concat(F.lit('"'), F.replace("c_name", F.lit("#"), F.lit('""')), F.lit('"'))
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")

    def line(*fields):
        return F.concat_ws(",", *fields)
    r = F.col("c_custkey") % 10
    segment = F.col("c_mktsegment")
    raw = (F.when(r == 1, line(key, name, nation, segment, F.lit("LOST"))).when(r == 2, line(key, name, nation))
           .when(r == 3, line(key, F.lit('"open'), nation, segment))
           .when(r == 4, line(key, name, F.concat(F.lit("n"), nation), segment))
           .when(r == 5, line(key, F.lit(""), nation, F.lit('""'))).otherwise(line(key, name, nation, segment)))
    path = scratch_path(spark, "damaged-csv")
    c.select(raw.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()), T.StructField("segment", T.StringType())])
    return read_csv_checked(spark, path, schema, header=False)


@register("csv_accepted", f"""
WITH {_CSV_SQL}
SELECT c_custkey, CASE WHEN c_custkey % 10 <> 5 THEN replace(substr(name, 2, length(name) - 2), '""', '"') END AS c_name,
       CAST(nation AS INTEGER) AS c_nationkey, CASE WHEN c_custkey % 10 = 5 THEN '' ELSE segment END AS segment
FROM lines WHERE c_custkey % 10 NOT IN (1, 2, 3, 4)
""")
def csv_accepted(spark, d):
    return _damaged_csv(spark, d).rows()


@register("csv_rejected", f"""
WITH {_CSV_SQL}
SELECT raw, CASE c_custkey % 10 WHEN 1 THEN 'surplus fields' WHEN 2 THEN 'missing fields' WHEN 3 THEN 'open quote'
            ELSE 'c_nationkey is not int' END AS reason
FROM lines WHERE c_custkey % 10 IN (1, 2, 3, 4)
""")
def csv_rejected(spark, d):
    return _damaged_csv(spark, d).rejected.select("raw", "reason")


# ==== nested notes (B14, B15, B19), signed measures (B7) ====================================

_CELL_SQL = """
cells AS (SELECT p_partkey, CASE p_partkey % 5
    WHEN 0 THEN p_name || ' (' || p_type || ' (' || p_size || ', ' || p_brand || '), ' || p_type || '), ' || p_brand
    WHEN 1 THEN p_name || ', ' || p_brand || ' (' || p_type || ' (' || p_size || '), rest, ' || p_name
    WHEN 2 THEN p_name || '), ' || p_brand || ' ((' || p_size || ', ' || p_type || ')), end (a) (b (c))'
    WHEN 3 THEN '((), ' || p_name || '), (' || p_size || ' (' || p_type || '))) , , ' || p_brand
    ELSE p_name || ', ' || p_brand || ' (' || p_size || ', one), ' || p_type END AS cell FROM part),
letters AS (SELECT p_partkey, cell, unnest(string_split(cell, '')) AS ch, unnest(range(length(cell))) AS i FROM cells)
"""


def _nested_cells(spark, d):
    p = load(spark, d, "part")
    size = F.col("p_size").cast("string")

    def cell(*parts):
        return F.concat(*[x if not isinstance(x, str) else F.col(x) if x in p.columns else F.lit(x) for x in parts])
    r = F.col("p_partkey") % 5
    return p.select("p_partkey", F.when(
        r == 0, cell("p_name", " (", "p_type", " (", size, ", ", "p_brand", "), ", "p_type", "), ", "p_brand")).when(
        r == 1, cell("p_name", ", ", "p_brand", " (", "p_type", " (", size, "), rest, ", "p_name")).when(
        r == 2, cell("p_name", "), ", "p_brand", " ((", size, ", ", "p_type", ")), end (a) (b (c))")).when(
        r == 3, cell("((), ", "p_name", "), (", size, " (", "p_type", "))) , , ", "p_brand")).otherwise(
        cell("p_name", ", ", "p_brand", " (", size, ", one), ", "p_type")).alias("cell"))


# a letter at a time: the running sum of parentheses, lifted by its smallest value so far
@register("nested_items", f"""
WITH {_CELL_SQL},
sums AS (SELECT *, sum(CASE ch WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY p_partkey ORDER BY i) AS s
         FROM letters),
depths AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY p_partkey ORDER BY i)) AS depth FROM sums),
cut AS (SELECT *, ch = ',' AND depth = 0 AS cut FROM depths),
numbered AS (SELECT *, sum(CAST(cut AS INTEGER)) OVER (PARTITION BY p_partkey ORDER BY i) AS item_no FROM cut)
SELECT p_partkey, trim(string_agg(ch, '' ORDER BY i)) AS item
FROM numbered WHERE NOT cut GROUP BY p_partkey, item_no
""")
def nested_items(spark, d):
    return _nested_cells(spark, d).select("p_partkey", F.explode(P.items_outside_parens("cell")).alias("item"))


@register("nested_notes", f"""
WITH {_CELL_SQL},
ahead AS (SELECT *, sum(CASE ch WHEN ')' THEN 1 WHEN '(' THEN -1 ELSE 0 END)
                    OVER (PARTITION BY p_partkey ORDER BY i DESC) AS s FROM letters),
left_over AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY p_partkey ORDER BY i DESC)) AS l FROM ahead),
opens AS (SELECT p_partkey, cell, ch, i, ch = '(' AND coalesce(lag(l) OVER (PARTITION BY p_partkey ORDER BY i DESC), 0) > 0
                 AS opens FROM left_over),
sums AS (SELECT *, sum(CASE WHEN opens THEN 1 WHEN ch = ')' THEN -1 ELSE 0 END)
                   OVER (PARTITION BY p_partkey ORDER BY i) AS s2 FROM opens),
depths AS (SELECT *, s2 - least(0, min(s2) OVER (PARTITION BY p_partkey ORDER BY i)) AS after FROM sums),
paired AS (SELECT *, coalesce(lag(after) OVER (PARTITION BY p_partkey ORDER BY i), 0) AS depth FROM depths),
grouped AS (SELECT *, sum(CAST(opens AND depth = 0 AS INTEGER)) OVER (PARTITION BY p_partkey ORDER BY i) AS g FROM paired),
notes AS (SELECT p_partkey, g, trim(coalesce(string_agg(ch, '' ORDER BY i)
                                    FILTER (WHERE depth > 0 AND NOT (ch = ')' AND depth = 1)), '')) AS note
          FROM grouped WHERE g > 0 GROUP BY p_partkey, g)
SELECT c.p_partkey, c.cell,
       (SELECT trim(coalesce(string_agg(ch, '' ORDER BY i), '')) FROM paired b
        WHERE b.p_partkey = c.p_partkey AND depth = 0 AND NOT opens) AS value,
       (SELECT coalesce(string_agg(note, ', ' ORDER BY g), '') FROM notes n WHERE n.p_partkey = c.p_partkey) AS note
FROM cells c
""")
def nested_notes(spark, d):
    n = P.split_note("cell")
    return _nested_cells(spark, d).select("p_partkey", "cell", n["value"].alias("value"), n["note"].alias("note"))


@register("section_in_the_middle", """
SELECT p_partkey, 'Near ' || t || CASE WHEN p_partkey % 2 = 0 THEN ' (the ' || t || ')' ELSE '' END AS label
FROM (SELECT p_partkey, upper(p_type[1]) || lower(p_type[2:]) AS t FROM part)
""")
def section_in_the_middle(spark, d):
    """Text behind the parenthesis that a section's name stands in is not part of it."""
    p = load(spark, d, "part")
    inner = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" (the "), "p_type", F.lit(")"))).otherwise(F.lit(""))
    name = F.concat("p_name", F.lit(" (Section near "), "p_type", inner, F.lit(") "), "p_brand")
    return p.select("p_partkey", P.section_name(name).alias("label"))


@register("signed_measures", """
SELECT p_partkey, p_size - 25 AS whole, CAST((p_size - 25) || CASE WHEN p_partkey % 3 = 2 THEN '.25' ELSE '' END AS DOUBLE)
         AS measured
FROM part
""")
def signed_measures(spark, d):
    size = (F.col("p_size") - 25).cast("string")
    r = F.col("p_partkey") % 3
    text = F.concat("p_brand", F.lit(", 40 or so, "), size, F.when(r == 0, F.lit(" degrees")).when(r == 1, F.lit("-ish Degrees"))
                    .otherwise(F.lit(".25 DEGREES")))
    return load(spark, d, "part").select("p_partkey", P.extract_number(text).alias("whole"),
                                         P.extract_number(text, type_="double").alias("measured"))


# ==== skewed lookup (J2, B20), top k (Q4, W3), maintained counts (A7, Q1), enforcing write (B21) =========

@register("lookup_spread", """
SELECT l.l_orderkey, l.l_linenumber, p.p_partkey AS part_id,
       CASE WHEN l.l_orderkey % 2 = 0 THEN 'part 7' WHEN l.l_orderkey % 11 = 0 THEN NULL
            ELSE 'part ' || l.l_partkey END AS part_name
FROM lineitem l LEFT JOIN part p
  ON 'part ' || p.p_partkey = CASE WHEN l.l_orderkey % 2 = 0 THEN 'part 7' WHEN l.l_orderkey % 11 = 0 THEN NULL
                                   ELSE 'part ' || l.l_partkey END
""")
def lookup_spread(spark, d):
    """Half of the rows have one value."""
    line = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(
        F.col("l_orderkey") % 2 == 0, F.lit("part 7")).when(F.col("l_orderkey") % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).alias("part_name"))
    part = load(spark, d, "part").select(F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("name"),
                                         "p_partkey")
    return (facts.lookup_spread(line, part, "part_name", "name", "p_partkey", as_="part_id")
            .select("l_orderkey", "l_linenumber", "part_id", "part_name"))


@register("q4_top_words", """
SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, word) AS BIGINT) AS Top, word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY word ORDER BY Top LIMIT 25
""")
def q4_top_words(spark, d):
    """The 25 most frequent words of all texts, without a count or sort of the vocabulary."""
    words = load(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return reports.top_by_frequency(words, "word", 25)


@register("report_in_order", """
SELECT row_number() OVER (ORDER BY qty DESC, s_name) AS place, l_suppkey, s_name, qty
FROM (SELECT l_suppkey, s_name, count(DISTINCT l_partkey) AS qty
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_name)
""")
def report_in_order(spark, d):
    """An ordered report with each row's place as it is read back from the written files."""
    from tidyspark.operators.keys import dense_key
    report = reports.count_distinct_by(load(spark, d, "lineitem"), "l_suppkey", "l_partkey", "qty",
                                       dim=load(spark, d, "supplier"), dim_key="s_suppkey", dim_cols=["s_name"])
    return dense_key(report.where("s_name IS NOT NULL"), [-F.col("qty"), F.col("s_name")], "place", unique=True).select(
        "place", "l_suppkey", "s_name", "qty")


@register("maintained_counts", """
SELECT l_suppkey, count(DISTINCT l_partkey) AS qty FROM lineitem GROUP BY l_suppkey
""")
def maintained_counts(spark, d):
    """Four overlapping batches and a fifth that was seen, instead of one count."""
    line = load(spark, d, "lineitem")
    counts = MaintainedCounts(spark, scratch_path(spark, "maintained"), "l_suppkey", "l_partkey", buckets=8)
    for rest in (0, 1, 2, 3, 1):
        counts.update(line.where((F.col("l_orderkey") % 4 == rest) | (F.col("l_linenumber") == 1)
                                 & (F.col("l_orderkey") % 4 < rest)))
    return counts.report()


_BROKEN_SQL = """
o AS (SELECT CASE WHEN o_orderkey % 50 = 7 THEN o_orderkey - 1 ELSE o_orderkey END AS o_orderkey,
             CASE WHEN o_orderkey % 40 = 3 THEN NULL WHEN o_orderkey % 40 = 5 THEN -o_custkey ELSE o_custkey END
               AS o_custkey,
             o_orderpriority FROM orders),
marked AS (SELECT *, CASE WHEN o_custkey IS NULL THEN 'not_null' WHEN length(o_orderpriority) > 8 THEN 'max_length'
                          WHEN o_custkey < 0 THEN 'foreign_key' END AS rule FROM o),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, rule IS NULL
                                        ORDER BY o_custkey, o_orderpriority) AS r FROM marked),
judged AS (SELECT *, CASE WHEN rule IS NOT NULL THEN rule WHEN r > 1 THEN 'primary_key' END AS found FROM ranked),
clean_lines AS (SELECT l_orderkey, l_linenumber FROM lineitem
                WHERE l_orderkey IN (SELECT o_orderkey FROM judged WHERE found IS NULL))
"""


def _enforced(spark, d):
    key = F.col("o_orderkey")
    orders = load(spark, d, "orders").select(
        F.when(key % 50 == 7, key - 1).otherwise(key).alias("o_orderkey"),
        F.when(key % 40 == 3, F.lit(None).cast("long")).when(key % 40 == 5, -F.col("o_custkey"))
         .otherwise(F.col("o_custkey")).alias("o_custkey"), "o_orderpriority")
    tables = {"customer": load(spark, d, "customer").select("c_custkey"), "orders": orders,
              "lineitem": load(spark, d, "lineitem").select("l_orderkey", "l_linenumber")}
    specs = [TableSpec("lineitem", foreign_keys=(fk("l_orderkey", "orders", "o_orderkey"),)),
             TableSpec("orders", primary_key=("o_orderkey",), not_null=("o_custkey",),
                       max_length={"o_orderpriority": 8}, foreign_keys=(fk("o_custkey", "customer", "c_custkey"),)),
             TableSpec("customer", primary_key=("c_custkey",))]
    clean, quarantine = enforce(tables, specs)
    return clean, quarantine, specs


@register("enforce_clean", f"""
WITH {_BROKEN_SQL} SELECT o_orderkey, o_custkey, o_orderpriority FROM judged WHERE found IS NULL
""")
def enforce_clean(spark, d):
    return _enforced(spark, d)[0]["orders"]


@register("enforce_quarantine", f"""
WITH {_BROKEN_SQL}
SELECT 'orders' AS table_name, found AS rule,
       CASE found WHEN 'max_length' THEN 'o_orderpriority' WHEN 'primary_key' THEN 'o_orderkey' ELSE 'o_custkey' END
         AS column_name, count(*) AS n
FROM judged WHERE found IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'lineitem', 'foreign_key', 'l_orderkey',
                 (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM clean_lines)
""")
def enforce_quarantine(spark, d):
    """Rows by broken rule; lines of quarantined orders follow them."""
    return _enforced(spark, d)[1].groupBy("table_name", "rule", "column_name").agg(F.count(F.lit(1)).alias("n"))


@register("enforce_audit", """
SELECT * FROM (VALUES ('lineitem', 'foreign_key_orphans', 'l_orderkey', 0::BIGINT),
  ('orders', 'primary_key_duplicates', 'o_orderkey', 0), ('orders', 'not_null', 'o_custkey', 0),
  ('orders', 'max_length', 'o_orderpriority', 0), ('orders', 'foreign_key_orphans', 'o_custkey', 0),
  ('customer', 'primary_key_duplicates', 'c_custkey', 0)) AS t(table_name, check_name, column_name, violations)
""")
def enforce_audit(spark, d):
    """The audit of the clean tables finds nothing."""
    clean, _, specs = _enforced(spark, d)
    return audit(clean, specs)
