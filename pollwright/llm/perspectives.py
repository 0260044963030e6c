"""Chat formatting by rotating the perspective of a dialogue with several speakers.

For every participant the dialogue is rendered with that speaker as the
assistant and the others as named users. Only what the assistant says is marked
for training.

A dialogue comes in parts of at most ``PART_TURNS`` turns, so a conversation
of any length is never gathered in one row or task. All of it is DataFrame
operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pollwright.llm.common import columns

PART_TURNS = 64
SYSTEM = "system"
NOBODY = "unknown"
#: The marks around a message.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def header(speaker: Column, own: Column) -> Column:
    role = (
        F.when(speaker == SYSTEM, F.lit(SYSTEM))
        .when(own, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), F.coalesce(speaker, F.lit(NOBODY))))
    )
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def rotate(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, perspective, block, piece, n_turns, text, spans`` for every participant.

    ``block`` is the turn number divided by ``PART_TURNS``, without remainder,
    and ``piece`` counts on where more rows than that share a block; ``block,
    piece`` is the order of the parts. ``spans`` lists start and end, in code
    points of ``text``, of what the assistant says with its closing mark;
    everything else is masked.

    Turns are ordered by number, speaker and text, nulls first; repeated rows stay. A
    speaker ``system`` is no participant, nor is null, whose turns are those of
    a user named ``unknown``, also where a participant has that name. Marks inside texts
    and names stay as they are. A null text is empty. Turns without conversation
    id are left out, and a conversation without participants gives no rows.
    Other columns are left out.
    """
    turns = columns(
        df, conv_id=conv_col, _turn=turn_col, _speaker=speaker_col, _text=text_col
    ).filter("conv_id is not null")
    people = (
        turns.filter(F.col("_speaker") != SYSTEM)
        .select("conv_id", F.col("_speaker").alias("perspective")).distinct()
    )
    block = F.floor(F.col("_turn") / PART_TURNS)
    seen = turns.join(people, "conv_id").withColumn("block", block)
    # dealt by part as well, so a long conversation is spread over tasks
    dealt = seen.repartition("conv_id", "perspective", "block")
    order = W.partitionBy("conv_id", "perspective", "block").orderBy("_turn", "_speaker", "_text")
    numbered = dealt.withColumn("_n", F.row_number().over(order) - 1).withColumn(
        "piece", F.floor(F.col("_n") / PART_TURNS)
    )
    # header and span follow one flag; a turn without speaker is nobody's own, whatever participants are called
    own = F.coalesce(F.col("_speaker") == F.col("perspective"), F.lit(False))
    message = F.struct(
        "_n",
        header(F.col("_speaker"), own).alias("head"),
        F.concat(F.coalesce("_text", F.lit("")), F.lit(CLOSE)).alias("body"),
        own.alias("own"),
    )
    parts = numbered.groupBy("conv_id", "perspective", "block", "piece").agg(
        F.array_sort(F.collect_list(message)).alias("_m")
    )
    rendered = F.array_join(
        F.transform("_m", lambda m: F.concat(m["head"], m["body"], F.lit("\n"))), ""
    )
    empty = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans")
    )

    def add(done: Column, m: Column) -> Column:
        start = done["at"] + F.length(m["head"])
        stop = start + F.length(m["body"])
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(
            (stop + 1).alias("at"),
            F.when(m["own"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"),
        )

    return parts.select(
        "conv_id", "perspective", "block", "piece",
        F.size("_m").alias("n_turns"),
        rendered.alias("text"),
        F.aggregate("_m", empty, add, lambda done: done["spans"]).alias("spans"),
    )


def oracle() -> str:
    """The same over ``conversations``, with the spans as text."""
    return f"""
WITH people AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations
    WHERE conv_id IS NOT NULL AND role <> '{SYSTEM}'),
m AS (SELECT c.conv_id, perspective, CAST(floor(turn / {PART_TURNS}.0) AS BIGINT) AS block, role = perspective AS own,
    row_number() OVER (PARTITION BY c.conv_id, perspective, floor(turn / {PART_TURNS}.0)
        ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS n,
    '{OPEN}' || CASE WHEN role = '{SYSTEM}' THEN '{SYSTEM}' WHEN role = perspective THEN 'assistant'
        ELSE 'user name=' || coalesce(role, '{NOBODY}') END || chr(10) AS head,
    coalesce(text, '') || '{CLOSE}' AS body
    FROM conversations c JOIN people p ON c.conv_id = p.conv_id),
s AS (SELECT *, n // {PART_TURNS} AS piece, coalesce(sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, perspective, block, n // {PART_TURNS} ORDER BY n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start FROM m)
SELECT conv_id, perspective, block, CAST(piece AS BIGINT) AS piece,
    CAST(count(*) AS INTEGER) AS n_turns,
    string_agg(head || body || chr(10), '' ORDER BY n) AS text,
    coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(body) AS BIGINT), ','
        ORDER BY n) FILTER (own), '') AS spans
FROM s GROUP BY conv_id, perspective, block, piece"""
