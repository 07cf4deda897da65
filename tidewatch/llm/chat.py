"""Chat formatting with cumulative-snapshot collapse.

A chat that is logged again after every turn leaves conversations that are beginnings of longer
ones. Every turn gets a hash of all turns up to it; a conversation whose last hash is also found
inside a longer one is dropped, and only maximal conversations are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import stored, table

# Turns of a conversation that one task orders together; a longer one is spread.
SEGMENT_TURNS = 4096
# The markers around a turn.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"

_LOW = 0xFFFFFFFF
_STATE = ("a", "b", "c", "d")


def _turns(conversations: DataFrame) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        text("role").alias("role"),
        text("text").alias("text"),
    )


def prefix_hashes(conversations: DataFrame, *, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Each turn with its position (from 1) and the hash of its conversation up to there.

    The hash is a sum, over the turns so far, of hashes of (position, role, text): it can be added
    up in segments, so that one conversation of any length is not a task of its own. Four sums of
    32-bit halves make up 128 bits.
    """
    turns = _turns(conversations).withColumn(
        "segment", F.floor(F.coalesce("turn", F.lit(-(2**62))) / segment_turns)
    )
    within = Window.partitionBy("conv_id", "segment").orderBy("turn", "role", "text")
    placed = turns.withColumn("place", F.row_number().over(within))
    sizes = placed.groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("turns"))
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(
        Window.unboundedPreceding, -1
    )

    def so_far(name: str) -> Column:
        return F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"{name}_before")

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"conv_id": "conv_r", "segment": "segment_r"})
        same = F.col("conv_id").eqNullSafe(F.col("conv_r")) & (
            F.col("segment") == F.col("segment_r")
        )
        return left.join(right, same).drop("conv_r", "segment_r")

    offsets = sizes.select("conv_id", "segment", so_far("turns"))
    placed = joined(placed, offsets).withColumn(
        "position", (F.col("place") + F.col("turns_before")).cast("long")
    )
    first = F.xxhash64("position", "role", "text")
    second = F.xxhash64("text", "role", "position", F.lit(1))
    parts = {
        "a": first.bitwiseAND(F.lit(_LOW)),
        "b": F.shiftrightunsigned(first, 32),
        "c": second.bitwiseAND(F.lit(_LOW)),
        "d": F.shiftrightunsigned(second, 32),
    }
    hashed = placed.withColumns(parts)
    sums = hashed.groupBy("conv_id", "segment").agg(*[F.sum(n).alias(n) for n in _STATE])
    sums = sums.select("conv_id", "segment", *[so_far(n) for n in _STATE])
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = hashed.withColumns({n: F.sum(n).over(running) for n in _STATE})
    summed = joined(summed, sums)
    digest = F.concat_ws("-", *[F.hex(F.col(n) + F.col(f"{n}_before")) for n in _STATE])
    return summed.select("conv_id", "turn", "role", "text", "position", digest.alias("prefix_hash"))


def collapse_snapshots(
    conversations: DataFrame, *, segment_turns: int = SEGMENT_TURNS
) -> DataFrame:
    """One row for each conversation: ``conv_id, n_turns, kept, n_copies``.

    Takes ``conv_id, turn, role, text``. A conversation is dropped if a longer one begins with all
    its turns, or if an equal one has a smaller id (null ids last). Turns are ordered by ``turn``
    (nulls first), ties by role and text, and only their order counts; null roles and texts are empty
    ones. All turns with a null ``conv_id`` make up one conversation. An empty table gives an empty
    result; other columns are ignored. ``n_copies`` counts conversations of equal turns.
    """
    hashed = stored(
        prefix_hashes(conversations, segment_turns=segment_turns).drop("role", "text"), "turns"
    )
    lengths = hashed.groupBy("conv_id").agg(F.max("position").alias("n_turns"))
    lengths = lengths.withColumnRenamed("conv_id", "conv_l")
    ends = hashed.join(
        lengths,
        F.col("conv_id").eqNullSafe(F.col("conv_l")) & (F.col("position") <= F.col("n_turns")),
    ).drop("conv_l")
    ends = stored(
        ends.select(
            "conv_id", "n_turns", "prefix_hash", (F.col("position") < F.col("n_turns")).alias("inner"),
            "position",
        ),
        "ends",
    )
    inner = ends.where("inner").select("position", "prefix_hash").distinct()
    whole = ends.where("not inner").select("conv_id", "n_turns", "position", "prefix_hash")
    groups = whole.groupBy("position", "prefix_hash").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("nameless"), "conv_id")).alias("first"),
        F.count(F.lit(1)).alias("n_copies"),
    )
    longer = inner.withColumn("longer", F.lit(True))
    return (
        whole.join(groups, ["position", "prefix_hash"])
        .join(longer, ["position", "prefix_hash"], "left")
        .select(
            "conv_id",
            "n_turns",
            (F.col("longer").isNull() & F.col("conv_id").eqNullSafe(F.col("first.conv_id"))).alias(
                "kept"
            ),
            "n_copies",
        )
    )


def render(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, chat``: the turns in order, each between the two markers.

    A rendered conversation is one text, so this gathers the turns of a conversation; call it on what
    :func:`collapse_snapshots` keeps. Null roles and texts are empty ones, a turn without number comes
    first, turns that tie are ordered by role and text, and repeated ones are all there. Turns without
    ``conv_id`` are one conversation. Other columns are not looked at. An empty table gives an empty
    result.
    """
    turns = _turns(conversations)
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    line = F.transform(
        "turns",
        lambda t: F.concat(
            F.lit(TURN_START), t["role"], F.lit("\n"), t["text"], F.lit(TURN_END)
        ),
    )
    return (
        turns.groupBy("conv_id")
        .agg(ordered.alias("turns"))
        .select("conv_id", F.size("turns").alias("n_turns"), F.array_join(line, "").alias("chat"))
    )


def format_chats(conversations: DataFrame, *, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Maximal conversations, rendered: ``conv_id, n_turns, n_copies, chat``.

    Nulls, ties, repeated turns and other columns are as in :func:`collapse_snapshots` and
    :func:`render`; an empty table gives an empty result.
    """
    kept = collapse_snapshots(conversations, segment_turns=segment_turns).where("kept")
    kept = kept.select(F.col("conv_id").alias("conv_k"), "n_copies")
    wanted = _turns(conversations).join(
        kept, F.col("conv_id").eqNullSafe(F.col("conv_k")), "left_semi"
    )
    return (
        render(wanted)
        .join(kept, F.col("conv_id").eqNullSafe(F.col("conv_k")))
        .select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies", "chat")
    )


def op1_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


SQL = {
    "op1_chat_snapshots": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations),
        c AS (
            SELECT conv_id, count(*) AS n_turns,
                   list({'r': role, 't': text} ORDER BY turn, role, text) AS turns,
                   string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10),
                              '' ORDER BY turn, role, text) AS chat
            FROM t GROUP BY conv_id),
        p AS (
            SELECT conv_id, n_turns, chat,
                   list_transform(range(1, n_turns), lambda i: turns[1:i]) AS inside, turns
            FROM c),
        i AS (SELECT DISTINCT unnest(inside) AS turns FROM p),
        g AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM p GROUP BY turns)
        SELECT p.conv_id, p.n_turns, g.n_copies, p.chat
        FROM p JOIN g ON p.turns = g.turns AND p.conv_id = g.conv_id
        WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.turns = p.turns)
    """
}
