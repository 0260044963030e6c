"""Surveys written as Markdown: questions and answers as tables.

Everything happens inside a document's row, so reading is map-only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: document shape -------------------------------------------
QUESTIONS = r"(?md)^## Questions[ \t]*$"
RESPONSES = r"(?md)^## Responses[ \t]*$"
RESPONDENT = r"(?md)^### Respondent (?=\S)"
TOP_BULLET = r"(?md)^(?=- \*\*.+?:\*\*)"
SUB_BULLET = r"(?md)^(?= +- \*\*.+?:\*\*)"
BULLET = r"(?ds)\A *- \*\*(.+?):\*\*(.*)\z"
# ----------------------------------------------------------------------------

DOCUMENT = ["dataset", "task", "format", "case_id"]


def _key(bullet: Column) -> Column:
    return F.regexp_extract(bullet, BULLET, 1)


def _value(bullet: Column) -> Column:
    """What follows the key, without the one blank and the closing line ends."""
    return F.regexp_replace(F.regexp_extract(bullet, BULLET, 2), r"\A |[\r\n]+\z", "")


def _entry(group: Column, bullet: Column) -> Column:
    return F.struct(
        group.alias("q_group"), _key(bullet).alias("q_key"), _value(bullet).alias("value"),
        F.regexp_extract(bullet, BULLET, 2).rlike(r"(?s)\A[^\S\n]|\S").alias("has_value"),
    )


def _entries(section: Column) -> Column:
    """Bullets in order; an indented bullet takes the key above it as its group."""
    top = F.filter(F.split(section, TOP_BULLET), lambda b: b.startswith("- **"))

    def below(bullet: Column) -> Column:
        parts = F.split(bullet, SUB_BULLET)
        head = F.get(parts, F.lit(0))
        subs = F.transform(
            F.slice(parts, 2, F.size(parts)), lambda sub: _entry(_key(head), sub)
        )
        return F.concat(F.array(_entry(F.lit(None).cast("string"), head)), subs)

    return F.flatten(F.transform(top, below))


def _after(text: Column, heading: str) -> Column:
    return F.coalesce(F.get(F.split(text, heading, 2), F.lit(1)), F.lit(""))


def answers(documents: DataFrame) -> DataFrame:
    """One row per answer of documents' ``content``.

    An empty value is an answer; a group heading with nothing after its colon
    is not.
    """
    blocks = F.split(_after(F.col("content"), RESPONSES), RESPONDENT)
    respondents = documents.select(
        *DOCUMENT, F.explode(F.slice(blocks, 2, F.size(blocks))).alias("_block")
    )
    entries = F.filter(_entries(F.col("_block")), lambda e: e["has_value"])
    return respondents.select(
        *DOCUMENT,
        F.regexp_extract("_block", r"\A(\S+)", 1).alias("respondent_id"),
        F.posexplode(entries).alias("pos", "_entry"),
    ).select(*DOCUMENT, "respondent_id", "pos", "_entry.q_group", "_entry.q_key", "_entry.value")


def questions(documents: DataFrame) -> DataFrame:
    """One row per question or question group, its label unparsed."""
    head = F.get(F.split(F.col("content"), RESPONSES, 2), F.lit(0))
    entries = _entries(_after(head, QUESTIONS))
    return documents.select(
        *DOCUMENT, F.posexplode(entries).alias("pos", "_entry")
    ).select(
        *DOCUMENT, "pos", "_entry.q_group", "_entry.q_key", F.col("_entry.value").alias("label")
    )
