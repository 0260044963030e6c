"""Prompt text: placeholders, sections, ablation variants, augmentations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pollwright.constants import (
    APPROACHES,
    DATA_BLOCK,
    EXAMPLE,
    EXAMPLE_MISSING,
    OUTPUT_FORMAT,
    QUESTION,
    QUESTIONNAIRE,
    REORDERED_SECTIONS,
    SECTIONS,
)
from pollwright.functions.text import SPACE, WHITESPACE, strip

_TAG = "(?:" + "|".join(SECTIONS) + ")"


def _swap(text: Column, placeholder: str, value: Column) -> Column:
    return F.replace(text, F.lit(placeholder), value)


def example_text(document: Column, question: Column, answer: Column) -> Column:
    """The worked example, or a fixed note where a part of it is missing."""
    shown = F.concat(
        document, F.lit("\n\nQuestion: "), F.coalesce(question, F.lit("")),
        F.lit("\nAnswer: "), F.coalesce(answer, F.lit("")),
    )
    return F.coalesce(shown, F.lit(EXAMPLE_MISSING))


def fill_placeholders(
    prompt: Column,
    fields: Column,
    question: Column,
    case_id: Column,
    document: Column,
    example: Column,
) -> Column:
    """Fill a template, each replacement working on the result of the last.

    ``fields`` is an array of ``struct<key, value, is_text>`` in the item's own
    order; text values take the document first. Then come the document, the
    question as given, the example, a field named like the case, and the
    document again for data blocks that came in with the values.
    """

    def value_of(field: Column) -> Column:
        value = F.coalesce(field["value"], F.lit("None"))
        with_document = _swap(_swap(value, DATA_BLOCK, document), QUESTIONNAIRE, document)
        return F.when(field["is_text"], with_document).otherwise(value)

    def placeholder(name: Column) -> Column:
        return F.concat(F.lit("["), F.upper(name), F.lit("]"))

    filled = F.aggregate(
        fields,
        prompt,
        lambda text, field: F.replace(text, placeholder(field["key"]), value_of(field)),
    )
    filled = _swap(filled, QUESTIONNAIRE, document)
    filled = F.when(question.isNull(), filled).otherwise(_swap(filled, QUESTION, question))
    filled = _swap(filled, EXAMPLE, example)
    named = F.get(F.filter(fields, lambda f: f["key"] == F.upper(case_id)), F.lit(0))
    filled = F.replace(
        filled,
        F.coalesce(F.when(named.isNotNull(), placeholder(case_id)), F.lit("")),
        F.coalesce(value_of(named), F.lit("")),
    )
    return _swap(filled, DATA_BLOCK, document)


def drop_section(prompt: Column, name: str) -> Column:
    """Remove a section, its tags and the whitespace after it, wherever it occurs."""
    return F.regexp_replace(prompt, rf"(?s)<{name}>.*?</{name}>{SPACE}*+", "")


def unwrap_sections(prompt: Column) -> Column:
    """Remove section tags, keep what they hold, leave at most one blank line.

    Blanks after an opening and before a closing tag go too. Trimming the
    pieces between closing tags spares a scan for blanks that precede one.
    """
    opened = F.regexp_replace(prompt, rf"<{_TAG}>{SPACE}*+", "")
    pieces = F.transform(
        F.split(opened, f"</{_TAG}>", -1), lambda piece: F.rtrim(piece, F.lit(WHITESPACE))
    )
    return F.regexp_replace(F.array_join(pieces, ""), r"\n{3,}+", "\n\n")


def reorder_sections(prompt: Column) -> Column:
    """First section of each name in fixed order; text between sections is lost."""
    first = [
        F.nullif(F.regexp_extract(prompt, rf"(?s)<{name}>.*?</{name}>", 0), F.lit(""))
        for name in REORDERED_SECTIONS
    ]
    return F.concat_ws("\n\n", *first)


# Add an entry to support another variant; results are stripped in the end.
VARIANT_STEPS = {
    "wo_change_order": reorder_sections,
    "wo_format_explaination": lambda prompt: drop_section(prompt, "format"),
    "wo_oneshot": lambda prompt: drop_section(prompt, "example"),
    "wo_partition_mark": unwrap_sections,
    "wo_role_prompting": lambda prompt: drop_section(prompt, "role"),
}


def apply_variant(prompt: Column, variant: str) -> Column:
    return strip(VARIANT_STEPS[variant](prompt))


def choose_variant(prompt: Column, variant: Column) -> Column:
    """The prompt changed as the ``variant`` column says; null for other names."""
    chosen = F.when(F.lit(False), prompt)
    for name in VARIANT_STEPS:
        chosen = chosen.when(variant == name, apply_variant(prompt, name))
    return chosen


def without_task(prompt: Column) -> Column:
    """A prompt's rest when its task and request sections are taken out."""
    return drop_section(drop_section(prompt, "task"), "request")


def task_body(prompt: Column) -> Column:
    return strip(F.regexp_extract(prompt, r"(?s)<task>(.*?)</task>", 1))


def approach_text(augmentation: Column) -> Column:
    """The approach section of an augmentation, empty for unknown names."""
    chosen = F.when(F.lit(False), F.lit(""))
    for name, text in APPROACHES.items():
        chosen = chosen.when(augmentation == name, F.lit(text))
    return chosen.otherwise(F.lit(""))


def output_position(rest: Column) -> Column:
    """Where the first complete output section starts, 0 where there is none."""
    start = F.locate("<output>", rest)
    closed = F.position(F.lit("</output>"), rest, start + 8)
    return F.when((start > 0) & (closed > 0), start).otherwise(0)


def augment(rest: Column, position: Column, task: Column, approach: Column) -> Column:
    """Put approach and output format before the output section, the task last."""
    added = F.concat(approach, F.lit("\n\n" + OUTPUT_FORMAT))
    before = F.substring(rest, F.lit(1), position - 1)
    after = F.substring(rest, position, F.length(rest))
    body = F.when(
        position > 0, F.concat(before, added, F.lit("\n\n"), after)
    ).otherwise(F.concat(rest, F.lit("\n\n"), added))
    return F.concat(body, F.lit("\n\n<task>\n"), task, F.lit("\n</task>"))
