"""Chat formatting: logged snapshots collapsed, maximal conversations rendered.

A log that is written again after each turn holds every conversation many
times, each a prefix of the next. Each prefix of a conversation has a rolling
hash: the exclusive or of the hashes of its turns, which hold their numbers.
Conversations whose whole hash is that of a proper prefix of another, or of an
equal one with a smaller id, are left out by an anti join; the rest is rendered.

Prefix hashes are summed in blocks of turns, then over the blocks of a
conversation, and rendered texts come in parts of one block each, so that no
task depends on how long a conversation is. Equal conversations and equal
prefixes are aggregated before they are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A block, and so a part, has turns whose numbers share all but this many bits.
BLOCK_BITS = 8
LAST = (1 << 63) - 1


def _turns(conversations: DataFrame) -> DataFrame:
    """Rows with an id; nulls in other columns replaced, the hash of the turn added."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.withColumn("block", F.shiftright("turn", BLOCK_BITS))


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``turns`` up to it, and their hash ``p1``, ``p2``."""
    hashed = _turns(conversations).select(
        "conv_id",
        "block",
        "turn",
        F.xxhash64("turn", "role", "text").alias("h1"),
        F.xxhash64(F.lit("turn"), "text", "role", "turn").alias("h2"),
    )
    # Repeated rows count once; different rows of one turn are taken together.
    turns = (
        hashed.distinct()
        .groupBy("conv_id", "block", "turn")
        .agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    running = turns.select(
        "conv_id",
        "block",
        "turn",
        F.bit_xor("h1").over(inside).alias("p1"),
        F.bit_xor("h2").over(inside).alias("p2"),
        F.count("*").over(inside).alias("turns"),
    )
    blocks = turns.groupBy("conv_id", "block").agg(
        F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"), F.count("*").alias("n")
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.bit_xor("b1").over(before), F.lit(0)).alias("b1"),
        F.coalesce(F.bit_xor("b2").over(before), F.lit(0)).alias("b2"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"),
    )
    return running.join(blocks, ["conv_id", "block"]).select(
        "conv_id",
        "turn",
        (F.col("turns") + F.col("n")).alias("turns"),
        F.col("p1").bitwiseXOR(F.col("b1")).alias("p1"),
        F.col("p2").bitwiseXOR(F.col("b2")).alias("p2"),
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` and ``n_copies`` of conversations that no other one begins with.

    Of equal ones the smallest id stands for all; ``n_copies`` counts them.
    """
    prefixes = prefix_hashes(conversations)
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct("turn", "turns", "p1", "p2")).alias("whole"))
    proper = (
        prefixes.join(whole.select("conv_id", F.col("whole.turn").alias("last")), "conv_id")
        .filter("turn < last")
        .select("turns", "p1", "p2")
        .distinct()
    )
    distinct = whole.groupBy("whole.turns", "whole.p1", "whole.p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies")
    )
    return distinct.join(proper, ["turns", "p1", "p2"], "left_anti").select("conv_id", "turns", "n_copies")


def render(conversations: DataFrame) -> DataFrame:
    """Maximal conversations as text.

    Returns ``conv_id``, ``part`` (turns 0 to 255 are part 0, and so on),
    ``n_turns`` and ``rendered`` of the part, and ``n_copies`` of the
    conversation. Parts in order give the whole text, in which each turn is
    ``<|role|>``, a line break, the text and another line break. Turns without
    a number come last; a null role or text is empty; repeated rows count once,
    different rows of one turn stand in the order of role and text. Rows
    without ``conv_id`` belong to no conversation. Other columns are not read.
    """
    kept = maximal(conversations).select("conv_id", "n_copies")
    turns = _turns(conversations).join(kept, "conv_id")
    parts = turns.groupBy("conv_id", F.col("block").alias("part"), "n_copies").agg(
        F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns")
    )
    lines = F.transform("turns", lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n")))
    return parts.select(
        "conv_id",
        "part",
        F.size(F.array_distinct(F.transform("turns", lambda t: t["turn"]))).cast("long").alias("n_turns"),
        "n_copies",
        F.concat_ws("", lines).alias("rendered"),
    )


def rendered_digest(conversations: DataFrame) -> DataFrame:
    return render(conversations).select(
        "conv_id",
        "part",
        "n_turns",
        "n_copies",
        F.length("rendered").cast("long").alias("n_chars"),
        F.sha2("rendered", 256).alias("rendered_sha256"),
    )


ORACLE = """
WITH rows AS (
    SELECT DISTINCT conv_id, coalesce(CAST(turn AS BIGINT), 9223372036854775807) AS turn,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT conv_id, turn, string_agg(role || chr(1) || text, chr(2) ORDER BY role, text) AS said
    FROM rows GROUP BY conv_id, turn
), prefixes AS (
    SELECT conv_id, turn, count(*) OVER w AS turns,
           sha256(string_agg(turn || chr(3) || said, chr(4)) OVER w) AS hash
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), whole AS (
    SELECT conv_id, max(turn) AS turn, arg_max(turns, turn) AS turns, arg_max(hash, turn) AS hash
    FROM prefixes GROUP BY conv_id
), proper AS (
    SELECT DISTINCT p.turns, p.hash FROM prefixes p JOIN whole w ON p.conv_id = w.conv_id AND p.turn < w.turn
), kept AS (
    SELECT min(conv_id) AS conv_id, count(*) AS n_copies FROM whole w
    WHERE NOT EXISTS (SELECT 1 FROM proper p WHERE p.turns = w.turns AND p.hash = w.hash)
    GROUP BY turns, hash
), parts AS (
    SELECT r.conv_id, r.turn >> 8 AS part, count(DISTINCT r.turn) AS n_turns, any_value(k.n_copies) AS n_copies,
           string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY r.turn, role, text) AS rendered
    FROM rows r JOIN kept k USING (conv_id) GROUP BY r.conv_id, r.turn >> 8
)
SELECT conv_id, part, n_turns, n_copies, length(rendered) AS n_chars, sha256(rendered) AS rendered_sha256 FROM parts
"""
