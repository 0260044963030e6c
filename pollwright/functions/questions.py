"""Question labels: text, type, options and bounds from ``text [type…]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: label shapes ---------------------------------------------
LABEL = r"(?s)\A(.*?)\s*\[(MCQ-Multi|MCQ|Likert|Rubric|Open-ended)\b:?\s*(.*)\]\s*\z"
BOUNDS = r"\A(-?\d+)\s*[–-]\s*(-?\d+)"
CHOICE = r"(?:^| )(?=(?:[A-Z]|\d+)\. )"
LEVEL = r"(?:^|, )(?=-?\d+ = )"
# ----------------------------------------------------------------------------


def _choices(body: Column) -> Column:
    """Lettered or numbered options in sequence.

    Labels may hold things like "B.S. " themselves, so a piece opens an option
    only if its code is the next one; else it belongs to the option before.
    """
    pieces = F.filter(F.split(body, CHOICE), lambda p: p != "")
    empty = F.array().cast("array<struct<code:string,label:string>>")

    def take(options: Column, piece: Column) -> Column:
        code = F.regexp_extract(piece, r"\A([A-Z]|\d+)\. ", 1)
        last = F.element_at(options, -1)
        following = F.when(
            last["code"].rlike(r"\A\d+\z"),
            (last["code"].try_cast("int") + 1).cast("string"),
        ).otherwise(F.char(F.ascii(last["code"]) + 1))
        opens = (F.size(options) == 0) | (code == following)
        label = F.regexp_replace(piece, r"\A(?:[A-Z]|\d+)\. ", "")
        added = F.struct(code.alias("code"), label.alias("label"))
        longer = F.struct(
            last["code"].alias("code"), F.concat_ws(" ", last["label"], piece).alias("label")
        )
        return F.when(opens, F.concat(options, F.array(added))).otherwise(
            F.concat(F.slice(options, F.lit(1), F.size(options) - 1), F.array(longer))
        )

    return F.aggregate(pieces, empty, take)


def _levels(body: Column) -> Column:
    """Scale points ``n = label`` separated by commas."""
    pieces = F.filter(F.split(body, LEVEL), lambda p: p.rlike(r"\A-?\d+ = "))
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.regexp_extract(p, r"\A(-?\d+) = ", 1).alias("code"),
            F.regexp_replace(p, r"\A-?\d+ = ", "").alias("label"),
        ),
    )


def with_question_type(rows: DataFrame, label: str = "label") -> DataFrame:
    """Add ``q_text, q_type, options, lo, hi``; sub-questions have no type.

    ``options`` is an array of ``struct<code, label>``; a rubric's bounds are
    its lowest and highest point.
    """
    typed = F.col(label).rlike(LABEL)
    body = F.col("_body")
    rows = rows.withColumns(
        {
            "q_text": F.when(typed, F.regexp_extract(label, LABEL, 1)).otherwise(F.col(label)),
            "q_type": F.when(typed, F.regexp_extract(label, LABEL, 2)),
            "_body": F.when(typed, F.regexp_extract(label, LABEL, 3)),
        }
    )
    kind = F.col("q_type")
    scale = F.regexp_replace(body, r"\A-?\d+\s*[–-]\s*-?\d+:?\s*", "")
    options = (
        F.when(kind.startswith("MCQ"), _choices(body))
        .when(kind == "Likert", _levels(scale))
        .when(kind == "Rubric", _levels(body))
    )
    rows = rows.withColumn("options", options)
    points = F.transform("options", lambda o: o["code"].try_cast("int"))
    bound = lambda n: F.regexp_extract(body, BOUNDS, n).try_cast("int")
    return rows.withColumns(
        {
            "lo": F.when(kind == "Likert", bound(1)).when(kind == "Rubric", F.array_min(points)),
            "hi": F.when(kind == "Likert", bound(2)).when(kind == "Rubric", F.array_max(points)),
        }
    ).drop("_body")
