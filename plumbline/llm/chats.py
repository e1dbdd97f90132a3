"""Operator 6: chat formatting after collapsing cumulative snapshots of conversations.

A logged conversation may be a snapshot of a longer one. Every turn is hashed with its place, and the
running sums of those hashes are rolling hashes of all turn prefixes. A conversation whose whole hash
is a proper prefix hash of another goes by an anti-join, and of equal conversations the least id
stays. The maximal conversations are rendered turn by turn with the offset of each turn in its text,
so a conversation of any length is rendered without being held in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.base import query, table
from plumbline.operators.scale import in_blocks
from plumbline.session import reliable_checkpoint

#: Turns of a conversation that one window sorts.
BLOCK = 4_096
OPENING, CLOSING = "<|im_start|>", "<|im_end|>\n"


def _halves(value: Column) -> tuple[Column, Column]:
    """A 64-bit hash as two numbers whose sums stay whole numbers."""
    return F.shiftrightunsigned(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))


def placed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (0, 1, ... in a conversation), turn, role, text.

    The order is turn number (nulls first), then role and text; only rows of one turn number, which
    share a block of turn numbers, are sorted together.
    """
    block = F.floor(F.col("turn") / BLOCK)
    rows = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text", block.alias("_block"))
    rows = rows.dropDuplicates()
    inside = Window.partitionBy("conv_id", "_block").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    sizes = rows.groupBy("conv_id", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("_block")).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("conv_id", F.col("_block").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    numbered = rows.withColumn("_i", F.row_number().over(inside) - 1)
    same = (F.col("conv_id") == F.col("_c")) & F.col("_block").eqNullSafe(F.col("_b"))
    return numbered.join(shifts.withColumnRenamed("conv_id", "_c"), same).select(
        "conv_id", (F.col("_shift") + F.col("_i")).cast("bigint").alias("place"), "turn", "role", "text"
    )


def maximal(placed: DataFrame) -> DataFrame:
    """conv_id and n_turns of the conversations that are no proper prefix of another, nor a repeat."""
    turn = F.xxhash64("place", "role", F.col("role").isNull(), "text", F.col("text").isNull())
    turn2 = F.xxhash64(F.lit(17), "text", F.col("text").isNull(), "role", F.col("role").isNull(), "place")
    (a, b), (c, d) = _halves(turn), _halves(turn2)
    sums = {"h1": a, "h2": b, "h3": c, "h4": d}
    hashed = placed.select("conv_id", "place", *[v.alias(f"_{k}") for k, v in sums.items()])
    rolling = reliable_checkpoint(in_blocks(hashed, ["conv_id"], "place", sums={k: F.col(f"_{k}") for k in sums}, width=BLOCK).select("conv_id", "place", *sums))
    lengths = reliable_checkpoint(rolling.groupBy("conv_id").agg(F.max("place").alias("last")))
    ends = rolling.join(lengths, "conv_id")
    whole = ends.where(F.col("place") == F.col("last")).groupBy("place", *sums).agg(F.min("conv_id").alias("conv_id"))
    prefixes = ends.where(F.col("place") < F.col("last")).select("place", *sums).distinct()
    return whole.join(prefixes, ["place", *sums], "left_anti").select("conv_id", (F.col("place") + 1).alias("n_turns"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, place, role, rendered and start of every turn of the maximal conversations.

    ``rendered`` is the turn in the chat format and ``start`` the code points of its conversation
    before it. Null roles and texts are rendered empty; turns with a null conv_id belong to no
    conversation and are left out; equal rows of a conversation count once; other columns are ignored.
    """
    placed = reliable_checkpoint(placed_turns(turns))
    kept = reliable_checkpoint(maximal(placed))
    rendered = F.concat(F.lit(OPENING), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSING))
    shown = placed.join(kept, "conv_id").select("conv_id", "n_turns", "place", "role", rendered.alias("rendered"))
    size = F.length("rendered").cast("bigint")
    offsets = in_blocks(shown.select("conv_id", "place", size.alias("_size")), ["conv_id"], "place", sums={"_end": F.col("_size")}, width=BLOCK)
    starts = offsets.select("conv_id", "place", (F.col("_end") - F.col("_size")).alias("start"))
    return shown.join(starts, ["conv_id", "place"])


SQL = """
WITH d AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place FROM d),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY place) AS turns, count(*) AS n_turns FROM p GROUP BY conv_id),
u AS (SELECT turns, n_turns, min(conv_id) AS conv_id FROM c GROUP BY turns, n_turns),
x AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM u)),
m AS (SELECT conv_id, n_turns FROM u WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.turns = u.turns)),
r AS (SELECT p.conv_id, m.n_turns, p.place, p.role, '<|im_start|>' || coalesce(p.role, '') || chr(10) || coalesce(p.text, '') || '<|im_end|>' || chr(10) AS rendered FROM p JOIN m USING (conv_id))
SELECT conv_id, n_turns, place, role, rendered,
  CAST(sum(length(rendered)) OVER (PARTITION BY conv_id ORDER BY place) - length(rendered) AS BIGINT) AS start
FROM r
"""


@query("op6_snapshot_chats", SQL)
def op6_snapshot_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maximal conversations, rendered turn by turn."""
    return render(table(spark, sf_dir, "conversations"))
