"""Chat formatting after collapsing cumulative snapshots.

Logs often hold a conversation several times, each time with a few more turns.
A turn's hash covers its position, role and text; the rolling hash of a prefix
is the exclusive-or of its turns' hashes (twice 64 bits). A conversation is a
snapshot if its full hash is the hash of a proper prefix of another one, or if
an equal one with a smaller id exists. Both are anti-joins on hashes, so no
pairs are formed, however many share a first turn.

Turns are numbered and collapsed by digests of their texts; the texts themselves
are read again at the end, for the kept conversations only. Positions and rolling
hashes come in two levels: inside blocks of turn numbers, and over the blocks of a
conversation, so that a conversation of any length is spread over tasks. Maximal
conversations are rendered in parts of at most ``part_turns`` turns.

Defined results: rows without a conversation id take no part; rows equal in
id, turn, role and text count once; different rows of one turn are ordered by
role, then by the text's digest, and null turns come first; a null role is
``unknown`` and a null text empty; an empty table gives no rows. Other columns
of the input are not read. Markers inside texts are broken by a space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyspark.llm.common import write_stage

BLOCK = 1024


BROADCAST_CONVERSATIONS = 1_000_000          # ids
TURN = ["conv", "turn", "role", "digest"]


def digested_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The turns (conv, turn, role, text, digest) of rows with a conversation id."""
    return (df.where(F.col(conv_id).isNotNull())
            .select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"),
                    F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .withColumn("digest", F.unhex(F.sha2("text", 256))))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Distinct turns (conv, block, position, turn, role, digest) with positions from 1 in each conversation."""
    rows = write_stage(turns.select(*TURN).distinct().withColumn("block", F.floor(F.col("turn") / BLOCK)), "chat-turns")
    before = (Window.partitionBy("conv").orderBy(F.asc_nulls_first("block"))
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .select(F.col("conv").alias("of_conv"), F.col("block").alias("of_block"), "offset"))
    inside = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    ranked = rows.withColumn("place", F.row_number().over(inside))
    return (ranked.join(offsets, (F.col("conv") == F.col("of_conv")) & F.col("block").eqNullSafe(F.col("of_block")))
            .select("conv", "block", (F.col("offset") + F.col("place")).alias("position"), "turn", "role", "digest"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Rows (conv, position, h1, h2): the rolling hash of the first ``position`` turns."""
    hashed = turns.select("conv", "block", "position", *[
        F.xxhash64(F.lit(seed), "position", "role", "digest").alias(f"t{seed}") for seed in (1, 2)])
    before = (Window.partitionBy("conv").orderBy(F.asc_nulls_first("block"))
              .rowsBetween(Window.unboundedPreceding, -1))
    blocks = hashed.groupBy("conv", "block").agg(*[F.bit_xor(f"t{s}").alias(f"b{s}") for s in (1, 2)])
    carried = blocks.select(F.col("conv").alias("of_conv"), F.col("block").alias("of_block"), *[
        F.coalesce(F.expr(f"bit_xor(b{s})").over(before), F.lit(0)).alias(f"c{s}") for s in (1, 2)])
    inside = (Window.partitionBy("conv", "block").orderBy("position")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rolled = hashed.select("conv", "block", "position", *[
        F.expr(f"bit_xor(t{s})").over(inside).alias(f"r{s}") for s in (1, 2)])
    return (rolled.join(carried, (F.col("conv") == F.col("of_conv")) & F.col("block").eqNullSafe(F.col("of_block")))
            .select("conv", "position", *[F.col(f"r{s}").bitwiseXOR(F.col(f"c{s}")).alias(f"h{s}") for s in (1, 2)]))


def maximal(prefixes: DataFrame) -> DataFrame:
    """Rows (conv, n_turns, n_copies) of the conversations that no other one contains as a prefix."""
    length = prefixes.groupBy("conv").agg(F.max("position").alias("n_turns"))
    with_length = write_stage(prefixes.join(length, "conv"), "chat-prefixes")
    whole = (with_length.where("position = n_turns").groupBy("n_turns", "h1", "h2")
             .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_copies")))
    inner = (with_length.where("position < n_turns")
             .select(F.col("position").alias("n_turns"), "h1", "h2").distinct())
    return whole.join(inner, ["n_turns", "h1", "h2"], "left_anti").select("conv", "n_turns", "n_copies")


def render(turns: DataFrame, numbered: DataFrame, kept: DataFrame, part_turns: int = 1024) -> DataFrame:
    """Rows (conv, part, n_turns, n_copies, rendered): the kept conversations in chat markup.

    A turn's text meets its position in a grouping that also drops repeated rows.
    """
    unmarked = F.regexp_replace("text", r"<\|im_", "< |im_")
    piece = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), unmarked, F.lit("<|im_end|>\n"))
    places = (numbered.join(kept, "conv")
              .select(*TURN, F.struct("position", "n_turns", "n_copies").alias("place"), F.lit(None).cast("string").alias("text")))
    if kept.count() <= BROADCAST_CONVERSATIONS:        # then texts of other conversations needn't be shuffled
        turns = turns.join(F.broadcast(kept.select("conv")), "conv", "left_semi")
    texts = turns.select(*TURN, F.lit(None).cast(places.schema["place"].dataType).alias("place"), "text")
    placed = (places.union(texts).groupBy(*TURN).agg(F.max("place").alias("place"), F.max("text").alias("text"))
              .where("place IS NOT NULL").select("conv", "role", "text", "place.*")
              .select("conv", "n_turns", "n_copies", F.floor((F.col("position") - 1) / part_turns).alias("part"),
                      F.struct("position", piece.alias("piece")).alias("one")))
    return (placed.groupBy("conv", "part", "n_turns", "n_copies")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list("one")), lambda o: o["piece"]), "")
                 .alias("rendered"))
            .select("conv", "part", "n_turns", "n_copies", "rendered"))


def chat_format(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", part_turns: int = 1024) -> DataFrame:
    turns = digested_turns(df, conv_id, turn, role, text)
    numbered = write_stage(numbered_turns(turns), "chat-numbered")
    kept = write_stage(maximal(prefix_hashes(numbered)), "chat-kept")
    return render(turns, numbered, kept, part_turns).withColumnRenamed("conv", conv_id)
