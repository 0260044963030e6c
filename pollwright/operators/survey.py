"""Queries over long answer tables (dataset, respondent_id, q_group, q_key, value).

``per`` names the columns that tell what a query is about: a whole survey, or
one case of it (``CASE``) where answers come from the document of a question.

Results that are sets of respondents come as rows, one per respondent: a
criterion may match a third of all respondents, which no single list should
hold. Where nothing matches, one row with the text ``None`` says so.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollwright.functions.answers import is_literal_list, literal_items
from pollwright.functions.text import strip
from pollwright.operators.joining import join_large, join_lookup

SURVEY = ("dataset",)
#: The key of one document: the six tasks ask about the respondents of one case.
CASE = ("dataset", "task", "case_id")
WHO = ["dataset", "respondent_id"]
NONE = "None"


def of_cases(answers: DataFrame, file_format: str) -> DataFrame:
    """Answers of the documents in one format, for queries ``per=CASE``."""
    return answers.filter(F.col("format") == file_format)


def distinct_values(answers: DataFrame, per: Sequence[str] = SURVEY) -> DataFrame:
    """One value for each respondent and question of a survey or case, the longest."""
    best = F.max(F.struct(F.length("value").alias("n"), F.col("value").alias("v")))["v"]
    return answers.groupBy(*per, "respondent_id", "q_key").agg(best.alias("value"))


def answer_lookup(answers: DataFrame, requests: DataFrame, per: Sequence[str] = SURVEY) -> DataFrame:
    """The value for each requested respondent and ``q_key``; ``None`` if missing.

    Requests have the columns ``per``, ``respondent_id`` and ``q_key``.
    """
    joined = requests.join(distinct_values(answers, per), [*per, "respondent_id", "q_key"], "left")
    return joined.withColumn(
        "value", F.coalesce(F.nullif("value", F.lit("")), F.lit(NONE))
    )


def reverse_lookup(answers: DataFrame, criteria: DataFrame, per: Sequence[str] = SURVEY) -> DataFrame:
    """Respondents giving each criterion's value; criteria: ``criterion``, ``per``, q_key, value.

    The answers are gone over once: one aggregation tells, per criterion and respondent
    and per criterion alone, whether there was a hit, so a criterion without any
    needs no second look at them.
    """
    who = answers.select(*per, "respondent_id", "q_key", "value")
    hits = join_lookup(who, criteria, [*per, "q_key", "value"], "inner").select(
        "criterion", "respondent_id", F.lit(True).alias("_hit")
    )
    asked = criteria.select("criterion").distinct().select(
        "criterion", F.lit(None).cast("string").alias("respondent_id"), F.lit(False).alias("_hit")
    )
    criterion, respondent = F.col("criterion"), F.col("respondent_id")
    told = hits.unionByName(asked).groupingSets([[criterion, respondent], [criterion]], criterion, respondent).agg(
        F.max("_hit").alias("_hit"), F.grouping("respondent_id").alias("_all")
    )
    found = told.filter(F.col("_hit") == (F.col("_all") == 0))
    return found.select("criterion", F.when(F.col("_all") == 1, NONE).otherwise(respondent).alias("respondent_id"))


def answer_text(found: DataFrame, by: Sequence[str], column: str = "respondent_id") -> DataFrame:
    """``answer`` per ``by``: the values, sorted, as the scorer expects them; ``None`` for none.

    For queries per case, whose respondents are those of one document.
    """
    values = F.array_sort(F.collect_set(F.col(column)))
    return found.groupBy(*by).agg(F.array_join(values, ", ").alias("answer")).withColumn(
        "answer", F.coalesce(F.nullif("answer", F.lit("")), F.lit(NONE))
    )


def concept_summary(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, sum, mean, least and greatest of a numeric value per concept."""
    number = F.col(value).try_cast("double") if dict(rows.dtypes)[value] == "string" else F.col(value)
    return rows.groupBy(*by).agg(
        F.count(number).alias("n"),
        F.sum(number).alias("total"),
        F.avg(number).alias("mean"),
        F.min(number).alias("least"),
        F.max(number).alias("greatest"),
    )


def concept_count(answers: DataFrame, concepts: DataFrame, per: Sequence[str] = SURVEY) -> DataFrame:
    """Answers falling under each concept, a set of (dataset, q_key, value) options.

    An answer counts once for its respondent, however often it is repeated.
    """
    given = answers.select(*dict.fromkeys([*per, *SURVEY]), "respondent_id", "q_key", "value").distinct()
    options = concepts.select("dataset", "concept", "q_key", "value").distinct()
    hits = join_lookup(given, options, ["dataset", "q_key", "value"], "inner")
    return hits.groupBy(*per, "concept").agg(F.count("*").alias("n"))


def related_respondents(
    answers: DataFrame,
    anchors: DataFrame,
    links: Sequence[str],
    where: dict[str, Column] | None = None,
    per: Sequence[str] = SURVEY,
) -> DataFrame:
    """Others sharing an anchor respondent's value on every linking question.

    Anchors are those that questions ask about; only their answers are made
    wide for the links. Each respondent meets the anchors with its own values;
    hot values are split by adaptive execution. For everybody's count of
    others, :func:`related_counts` never pairs anyone. ``where`` gives further
    conditions by question key, on that key's column of :func:`wide_view`.
    """
    where, per = where or {}, list(per)
    wide = wide_view(answers, list(dict.fromkeys([*links, *where])), per)
    named = anchors.select(*per, "respondent_id").distinct()
    asked = answers.join(named, [*per, "respondent_id"], "left_semi")
    own = wide_view(asked, links, per).withColumnRenamed("respondent_id", "anchor_id")
    others = reduce(lambda df, condition: df.filter(condition), where.values(), wide)
    hits = join_large(others, own, [*per, *links])
    return hits.filter(F.col("respondent_id") != F.col("anchor_id")).select(
        *per, "anchor_id", "respondent_id"
    )


def related_counts(answers: DataFrame, links: Sequence[str], per: Sequence[str] = SURVEY) -> DataFrame:
    """For every respondent, how many others share all linking values.

    Counted per combination of values and handed back, so the work stays
    linear where pairing respondents would be quadratic in a common value. The
    wide rows are shuffled once and used by both.
    """
    per = list(per)
    wide = wide_view(answers, links, per).dropna(subset=list(links))
    sizes = wide.groupBy(*per, *links).agg(F.count("*").alias("_n"))
    joined = join_large(wide, sizes, [*per, *links])
    return joined.select(*per, "respondent_id", (F.col("_n") - 1).alias("related"))


def respondent_count(
    answers: DataFrame, condition: Column, by: Sequence[str] = (), per: Sequence[str] = SURVEY
) -> DataFrame:
    """Distinct respondents with an answer meeting the condition."""
    who = [c for c in (*per, "respondent_id") if c not in by]
    met = answers.filter(condition).select(*by, *who).distinct()
    return met.groupBy(*by).agg(F.count("*").alias("respondents"))


def rule_matches(
    answers: DataFrame,
    rules: Sequence[tuple[str, Column]],
    at_least: int | None = None,
    per: Sequence[str] = SURVEY,
) -> DataFrame:
    """Respondents meeting rules, each a question key and a condition on ``value``.

    All rules must hold, or ``at_least`` that many (1 for any of them).
    """
    need = len(rules) if at_least is None else at_least
    held = [
        F.max(F.when((F.col("q_key") == key) & rule, 1).otherwise(0)) for key, rule in rules
    ]
    keys = sorted({key for key, _ in rules})
    matching = answers.filter(F.col("q_key").isin(keys)).groupBy(*per, "respondent_id").agg(
        reduce(lambda a, b: a + b, held).alias("held")
    )
    return matching.filter(F.col("held") >= need).select(*per, "respondent_id")


def option_labels(questions: DataFrame) -> DataFrame:
    """(dataset, q_key, code, label) of questions with parsed ``options``."""
    return questions.select("dataset", "q_key", F.explode("options").alias("o")).select(
        "dataset", "q_key", F.upper("o.code").alias("code"), F.col("o.label").alias("label")
    ).distinct()


def plain_code(value: Column) -> Column:
    """An answer code as options spell it: upper case, ``1.0`` as ``1``."""
    return F.upper(F.regexp_replace(F.trim(value), r"\A(\d+)\.0+\z", "$1"))


def decode_options(answers: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the label of each answer's code; null where there is no such option."""
    coded = answers.withColumn("code", plain_code(F.col("value")))
    return join_lookup(coded, labels, ["dataset", "q_key", "code"], "left")


def explode_choices(answers: DataFrame, separator: str = ";") -> DataFrame:
    """One row per chosen item of a multi-select value.

    A value printed as a list is told by its shape, whatever the question's
    type; other values are split at the separator, a plain text, and stripped.
    Empty items are no choice.
    """
    value = F.col("value")
    parts = F.split(value, rf"\Q{separator}\E")
    items = F.when(is_literal_list(value), literal_items(value)).otherwise(F.transform(parts, strip))
    return answers.withColumn("item", F.explode(F.filter(items, lambda item: item != "")))


def wide_view(answers: DataFrame, keys: Sequence[str], per: Sequence[str] = SURVEY) -> DataFrame:
    """One row per respondent, one column per question; of two values the longer counts.

    A single grouping with conditional aggregates, where a pivot takes two.
    """
    def longest(key: str) -> Column:
        value = F.when(F.col("q_key") == key, F.col("value"))
        return F.max(F.struct(F.length(value).alias("n"), value.alias("v")))["v"].alias(key)

    wanted = answers.filter(F.col("q_key").isin(list(keys)))
    return wanted.groupBy(*per, "respondent_id").agg(*(longest(k) for k in keys))


def one_per_respondent(answers: DataFrame) -> DataFrame:
    """De-duplicate answers repeated over cases, keeping the longest value."""
    best = F.max(F.struct(F.length("value").alias("n"), F.col("value").alias("v")))["v"]
    return answers.groupBy(*WHO, "q_group", "q_key").agg(best.alias("value"))


def typed_value(value: Column) -> Column:
    """An answer as number and date where it reads as one, null where empty."""
    kept = F.nullif(value, F.lit(""))
    return F.struct(
        kept.alias("text"),
        kept.try_cast("double").alias("number"),
        F.when(kept.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), kept.try_cast("date")).alias("date"),
    )
