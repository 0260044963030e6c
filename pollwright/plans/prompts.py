"""Queries over prompt tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.constants import APPROACHES, FORMATS, OUTPUT_FORMAT, REORDERED_SECTIONS, VARIANTS
from pollwright.functions import templates
from pollwright.operators import prompts
from pollwright.plans import fixtures
from pollwright.plans.oracle import DOCUMENTS, FILLED, ITEMS, SKIPS, WS, items as sql_list, strip, text
from pollwright.plans.registry import query


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.filled_prompts(
        fixtures.keyed_items(spark, sf_dir),
        fixtures.survey_documents(spark, sf_dir),
        fixtures.skip_list(spark, sf_dir),
    )


def narrow_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.question_items(spark, sf_dir).select(
        "dataset", "task", "case_id", "pos", "question", "expected_answer"
    )


def dropped(x: str, name: str) -> str:
    return f"regexp_replace({x}, '(?s)<{name}>.*?</{name}>{WS}*', '', 'g')"


_TAG = "(example|questionnaire|role|format|request|output|task)"
_UNWRAPPED = (
    f"regexp_replace(regexp_replace(regexp_replace(prompt, '<{_TAG}>{WS}*', '', 'g'),"
    f" '{WS}*</{_TAG}>', '', 'g'), '\\n\\n\\n+', chr(10) || chr(10), 'g')"
)
_REORDERED = "concat_ws(chr(10) || chr(10), " + ", ".join(
    f"nullif(regexp_extract(prompt, '(?s)<{s}>.*?</{s}>'), '')" for s in REORDERED_SECTIONS
) + ")"
VARIANT_SQL = {
    "wo_change_order": strip(_REORDERED),
    "wo_format_explaination": strip(dropped("prompt", "format")),
    "wo_oneshot": strip(dropped("prompt", "example")),
    "wo_partition_mark": strip(_UNWRAPPED),
    "wo_role_prompting": strip(dropped("prompt", "role")),
}
_REST = dropped(dropped("prompt", "task"), "request")
_TASK_BODY = strip("regexp_extract(prompt, '(?s)<task>(.*?)</task>', 1)")


def augmented_sql(approach: str, source: str = "filled") -> str:
    added = f"{approach} || {text(chr(10) * 2 + OUTPUT_FORMAT)}"
    gap = text("\n\n")
    return f"""parts AS (SELECT *, {_TASK_BODY} AS body, {_REST} AS rest FROM {source}),
    cut AS (SELECT *, CASE WHEN regexp_matches(rest, '(?s)<output>.*?</output>')
      THEN instr(rest, '<output>') ELSE 0 END AS spot FROM parts),
    augmented AS (SELECT * EXCLUDE (prompt), CASE WHEN spot > 0
      THEN substr(rest, 1, spot - 1) || {added} || {gap} || substr(rest, spot)
      ELSE rest || {gap} || {added} END || {text(chr(10) * 2 + '<task>' + chr(10))} || body
      || {text(chr(10) + '</task>')} AS prompt FROM cut)"""


@query("s3_skip_list", f"WITH {SKIPS} SELECT * FROM skips")
def s3(spark, sf_dir):
    return fixtures.skip_list(spark, sf_dir).distinct()


@query(
    "f4_documents_without_items_pruned",
    f"""WITH {ITEMS}, {DOCUMENTS} SELECT dataset, task, case_id, format FROM docs
    WHERE (dataset, task, case_id) IN (SELECT (dataset, task, case_id) FROM items)""",
)
def f4(spark, sf_dir):
    items = narrow_items(spark, sf_dir).select(*prompts.CASE)
    docs = fixtures.survey_documents(spark, sf_dir).select(*prompts.CASE, "format")
    return docs.join(items, prompts.CASE, "left_semi")


@query(
    "f7_prompt_layout",
    f"""WITH {FILLED} SELECT dataset, format, case_id, task, question, content AS questionnaire,
    expected_answer, {dropped('prompt', 'request')} AS prompt, '' AS "Response", '' AS "Correct", skip
    FROM filled""",
)
def f7(spark, sf_dir):
    return prompts.prompt_layout(prompts.base_prompts(filled(spark, sf_dir)), "dataset", "format")


@query(
    "j1_items_with_documents",
    f"""WITH {ITEMS}, {DOCUMENTS} SELECT i.pos, d.format, i.question, d.content
    FROM items i JOIN docs d USING (dataset, task, case_id)""",
)
def j1(spark, sf_dir):
    joined = prompts.items_with_documents(
        narrow_items(spark, sf_dir), fixtures.survey_documents(spark, sf_dir)
    )
    return joined.select("pos", "format", "question", "content")


@query(
    "j1_missing_documents",
    f"""WITH {ITEMS}, {DOCUMENTS} SELECT i.dataset, i.task, i.case_id, i.pos, f.format
    FROM items i CROSS JOIN (SELECT unnest({sql_list(FORMATS)}) AS format) f
    LEFT JOIN docs d USING (dataset, task, case_id, format) WHERE d.content IS NULL""",
)
def j1_missing(spark, sf_dir):
    return prompts.missing_documents(
        narrow_items(spark, sf_dir), fixtures.survey_documents(spark, sf_dir)
    ).select("dataset", "task", "case_id", "pos", "format")


@query(
    "j2_skip_flag",
    f"""WITH {DOCUMENTS}, {SKIPS} SELECT d.dataset, d.task, d.case_id, d.format,
    CASE WHEN s.case_id IS NULL THEN 'FALSE' ELSE 'TRUE' END AS skip
    FROM docs d LEFT JOIN skips s USING (dataset, task, case_id)""",
)
def j2(spark, sf_dir):
    docs = fixtures.survey_documents(spark, sf_dir).select(*prompts.CASE, "format")
    rows = prompts.with_skip_flag(docs.withColumn("pos", F.lit(0)), fixtures.skip_list(spark, sf_dir))
    return rows.select(*prompts.CASE, "format", "skip")


@query("j3_worked_examples", f"WITH {FILLED} SELECT * FROM examples")
def j3(spark, sf_dir):
    return prompts.worked_examples(
        narrow_items(spark, sf_dir), fixtures.survey_documents(spark, sf_dir)
    )


@query(
    "j4_variant_expansion",
    f"""WITH {FILLED}, spread AS (SELECT *, unnest({sql_list(VARIANTS)}) AS variant FROM filled)
    SELECT pos, format, variant, md5(CASE variant
    {" ".join(f"WHEN '{v}' THEN {sql}" for v, sql in VARIANT_SQL.items())} END) AS digest FROM spread""",
)
def j4_variants(spark, sf_dir):
    rows = prompts.variant_prompts(filled(spark, sf_dir))
    return rows.select("pos", "format", "variant", F.md5("prompt").alias("digest"))


_APPROACH_CASE = "CASE self_aug " + " ".join(
    f"WHEN '{k}' THEN {text(v)}" for k, v in APPROACHES.items()
) + " ELSE '' END"


@query(
    "j4_augmentation_expansion",
    f"""WITH {FILLED}, spread AS (SELECT *, unnest({sql_list(list(APPROACHES))}) AS self_aug FROM filled),
    {augmented_sql(_APPROACH_CASE, 'spread')}
    SELECT pos, format, self_aug, md5(prompt) AS digest FROM augmented""",
)
def j4_augmentations(spark, sf_dir):
    rows = prompts.augmented_prompts(filled(spark, sf_dir))
    return rows.select("pos", "format", "self_aug", F.md5("prompt").alias("digest"))


@query("t1_fill_placeholders", f"WITH {FILLED} SELECT pos, format, prompt FROM filled")
def t1(spark, sf_dir):
    return filled(spark, sf_dir).select("pos", "format", "prompt")


@query("t2_drop_request", f"WITH {FILLED} SELECT pos, format, md5({dropped('prompt', 'request')}) AS digest FROM filled")
def t2(spark, sf_dir):
    return prompts.base_prompts(filled(spark, sf_dir)).select("pos", "format", F.md5("prompt").alias("digest"))


@query("t2_drop_section_in_pages", f"SELECT page_id, {dropped('html', 'script')} AS html FROM pages")
def t2_pages(spark, sf_dir):
    pages = fixtures.table(spark, sf_dir, "pages")
    return pages.select("page_id", templates.drop_section(F.col("html"), "script").alias("html"))


def _variant(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        changed = templates.apply_variant(F.col("prompt"), name)
        return filled(spark, sf_dir).select("pos", "format", F.md5(changed).alias("digest"))

    return run


for _name, _variant_name in (
    ("t3_wo_format_explaination", "wo_format_explaination"),
    ("t4_wo_oneshot", "wo_oneshot"),
    ("t5_wo_role_prompting", "wo_role_prompting"),
    ("t6_wo_partition_mark", "wo_partition_mark"),
    ("t7_wo_change_order", "wo_change_order"),
):
    query(
        _name,
        f"WITH {FILLED} SELECT pos, format, md5({VARIANT_SQL[_variant_name]}) AS digest FROM filled",
    )(_variant(_variant_name))


@query(
    "t8_variant_dispatch",
    f"""WITH {ITEMS}, chosen AS (SELECT *, {sql_list([*VARIANTS, 'unknown'])}[CAST(pos % 6 AS INT) + 1]
      AS variant FROM items)
    SELECT pos, variant, CASE variant {" ".join(f"WHEN '{v}' THEN {sql}" for v, sql in VARIANT_SQL.items())}
    END AS prompt FROM chosen""",
)
def t8(spark, sf_dir):
    items = fixtures.question_items(spark, sf_dir)
    variant = fixtures.pick([*VARIANTS, "unknown"], F.col("pos") % 6)
    rows = items.select("pos", variant.alias("variant"), "prompt")
    return rows.select("pos", "variant", templates.choose_variant(F.col("prompt"), F.col("variant")).alias("prompt"))


def _augmentation(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = prompts.augmented_prompts(filled(spark, sf_dir), [kind])
        return rows.select("pos", "format", F.md5("prompt").alias("digest"))

    return run


for _name, _kind in (
    ("t9_format_explaination", "format_explaination"),
    ("t10_critical_values", "critical_values"),
    ("t11_structural_info", "structural_info"),
):
    query(
        _name,
        f"WITH {FILLED}, {augmented_sql(text(APPROACHES[_kind]))} SELECT pos, format, md5(prompt) AS digest FROM augmented",
    )(_augmentation(_kind))


def _prompt_rows(prompt: str, extra: str, source: str) -> str:
    return f"""SELECT {extra}dataset, format, case_id, task, question, md5(content) AS questionnaire,
    expected_answer, md5({prompt}) AS prompt, '' AS "Response", '' AS "Correct", skip FROM {source}"""


def _digested(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"questionnaire": F.md5("questionnaire"), "prompt": F.md5("prompt")})


@query("k1_prompt_table", f"WITH {FILLED} {_prompt_rows(dropped('prompt', 'request'), '', 'filled')}")
def k1(spark, sf_dir):
    return _digested(prompts.prompt_layout(prompts.base_prompts(filled(spark, sf_dir)), "dataset", "format"))


@query(
    "k2_variant_table",
    f"""WITH {FILLED}, spread AS (SELECT *, unnest({sql_list(VARIANTS)}) AS variant FROM filled)
    {_prompt_rows("CASE variant " + " ".join(f"WHEN '{v}' THEN {q}" for v, q in VARIANT_SQL.items()) + " END", 'variant, ', 'spread')}""",
)
def k2(spark, sf_dir):
    rows = prompts.variant_prompts(filled(spark, sf_dir))
    return _digested(prompts.prompt_layout(rows, "variant", "dataset", "format"))


@query(
    "k3_augmented_table",
    f"""WITH {FILLED}, spread AS (SELECT *, unnest({sql_list(list(APPROACHES))}) AS self_aug FROM filled),
    {augmented_sql(_APPROACH_CASE, 'spread')} {_prompt_rows('prompt', 'self_aug, ', 'augmented')}""",
)
def k3(spark, sf_dir):
    rows = prompts.augmented_prompts(filled(spark, sf_dir))
    return _digested(prompts.prompt_layout(rows, "self_aug", "dataset", "format"))
