import pytest
from pyspark.sql import functions as F

from pollwright.constants import APPROACHES, EXAMPLE_MISSING, OUTPUT_FORMAT
from pollwright.functions import templates
from pollwright.operators import joining, prompts

PROMPT = (
    "intro <example>\nE\n</example>\n\n<questionnaire>Q</questionnaire> mid <role>R</role>\n"
    "<format>F</format>\n\n\n\n<request>ask</request>\n <output>O</output><task> T </task>\n"
)


def applied(spark, column_of, prompt=PROMPT):
    return spark.createDataFrame([(prompt,)], "p string").select(column_of(F.col("p"))).first()[0]


def variant(spark, name, prompt=PROMPT):
    return applied(spark, lambda p: templates.apply_variant(p, name), prompt)


def test_drop_section_takes_the_blanks_after_it(spark):
    got = applied(spark, lambda p: templates.drop_section(p, "request"))
    assert got == PROMPT.replace("<request>ask</request>\n ", "")


def test_unwrap_keeps_content(spark):
    got = variant(spark, "wo_partition_mark")
    assert got == "intro E\n\nQ mid R\nF\n\nask\n OT"


def test_reorder_skips_absent_and_loses_text_between(spark):
    got = variant(spark, "wo_change_order", PROMPT.replace("<role>R</role>", ""))
    assert got == "\n\n".join(
        ["<example>\nE\n</example>", "<format>F</format>", "<request>ask</request>", "<output>O</output>",
         "<task> T </task>", "<questionnaire>Q</questionnaire>"]
    )


def test_only_first_section_of_a_name_is_reordered(spark):
    assert variant(spark, "wo_change_order", "<role>1</role><role>2</role>") == "<role>1</role>"


def test_other_variants_drop_one_section(spark):
    assert "<role>" not in variant(spark, "wo_role_prompting")
    assert variant(spark, "wo_oneshot").startswith("intro <questionnaire>")
    assert "<format>" not in variant(spark, "wo_format_explaination")


def augmented(spark, kind, prompt):
    df = spark.createDataFrame([(prompt,)], "prompt string")
    return prompts.augmented_prompts(df, [kind]).first()["prompt"]


@pytest.mark.parametrize("kind", list(APPROACHES))
def test_augmentation_goes_before_the_output_section(spark, kind):
    got = augmented(spark, kind, "a<task> T\n</task> b<request>x</request> c<output>O</output>d")
    added = APPROACHES[kind] + "\n\n" + OUTPUT_FORMAT
    assert got == f"ab" f"c{added}\n\n<output>O</output>d\n\n<task>\nT\n</task>"


def test_augmentation_without_output_section_is_appended(spark):
    got = augmented(spark, "critical_values", "a</output><output>b")
    added = APPROACHES["critical_values"] + "\n\n" + OUTPUT_FORMAT
    assert got == f"a</output><output>b\n\n{added}\n\n<task>\n\n</task>"


FIELD = "array<struct<key: string, value: string, is_text: boolean>>"


def fill(spark, prompt, fields, question="raw [X]", case_id="case_2", document="DOC", example="EX"):
    df = spark.createDataFrame(
        [(prompt, fields, question, case_id, document, example)],
        f"p string, f {FIELD}, q string, c string, d string, e string",
    )
    return df.select(templates.fill_placeholders(*(F.col(c) for c in "pfqcde"))).first()[0]


def test_fields_are_replaced_in_their_own_order(spark):
    fields = [("a", "[B]", True), ("b", "two", True)]
    assert fill(spark, "[A] [B]", fields) == "two two"
    assert fill(spark, "[A] [B]", fields[::-1]) == "[B] two"


def test_text_fields_take_the_document_and_others_do_not(spark):
    fields = [("a", "<[questionnaire]>", True), ("n", "[questionnaire]?", False)]
    # The number's text is replaced by the later general step.
    assert fill(spark, "[A] [N]", fields) == "<DOC> DOC?"


def test_question_example_and_data_block(spark):
    got = fill(spark, "[question]|[CASE_1]|[Insert the full data block here]|[questionnaire]", [])
    assert got == "raw [X]|EX|DOC|DOC"


def test_replacement_is_literal(spark):
    assert fill(spark, "[question]", [], question="$1 \\ (") == "$1 \\ ("


def test_placeholder_in_the_example_is_left(spark):
    assert fill(spark, "[CASE_1]", [], example="[question]") == "[question]"


def test_field_named_like_the_case(spark):
    assert fill(spark, "[CASE_1]", [("CASE_2", "own", True)], example="see [CASE_2]") == "see own"


DOCUMENT = "dataset string, task string, format string, case_id string, content string"
ITEM = "dataset string, task string, pos long, case_id string, question string, expected_answer string, prompt string"


def tables(spark):
    items = [
        ("d", "t", 0, "case_1", "q1", "a1", "[CASE_1]"),
        ("d", "t", 1, "case_1", "q1b", "a1b", "[CASE_1]"),
        ("d", "t", 2, "case_2", "q2", None, "[CASE_1]"),
        ("e", "t", 0, "case_2", "q3", "a3", "[CASE_1]"),
    ]
    docs = [
        ("d", "t", "md", "case_1", "D1md"),
        ("d", "t", "md", "case_2", "D2md"),
        ("d", "t", "ttl", "case_2", "D2ttl"),
        ("e", "t", "md", "case_2", "E2"),
    ]
    skips = [("d", "t", "case_2"), ("d", "t", "case_2")]
    items = spark.createDataFrame(items, ITEM).withColumn("fields", F.array().cast(FIELD))
    return items, spark.createDataFrame(docs, DOCUMENT), spark.createDataFrame(skips, "dataset string, task string, case_id string")


def test_prompt_table(spark):
    rows = prompts.prompt_layout(prompts.base_prompts(prompts.filled_prompts(*tables(spark))), "dataset", "format")
    got = sorted((r["dataset"], r["format"], r["question"], r["prompt"], r["skip"], r["expected_answer"]) for r in rows.collect())
    shown = "D1md\n\nQuestion: q1\nAnswer: a1"
    assert got == [
        ("d", "md", "q1", shown, "FALSE", "a1"),
        ("d", "md", "q1b", shown, "FALSE", "a1b"),
        ("d", "md", "q2", shown, "TRUE", ""),
        ("d", "ttl", "q2", EXAMPLE_MISSING, "TRUE", ""),
        ("e", "md", "q3", EXAMPLE_MISSING, "FALSE", "a3"),
    ]


def test_missing_documents(spark):
    items, docs, _ = tables(spark)
    got = {(r["dataset"], r["pos"], r["format"]) for r in prompts.missing_documents(items, docs, ["md", "ttl"]).collect()}
    assert got == {("d", 0, "ttl"), ("d", 1, "ttl"), ("e", 0, "ttl")}


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_joins_agree_whatever_the_measured_size(spark, how):
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    plain = left.join(right, "k", how)
    for limit in (0, 1 << 20):
        looked = joining.join_lookup(left, right, ["k"], how, broadcast_limit=limit)
        assert plain.select(looked.columns).exceptAll(looked).count() == 0 and plain.count() == looked.count()
    assert joining.measured_bytes(right) == sum(len(f'{{"k":{i},"v":{i * 7}}}') for i in range(40))


def test_no_document_is_shuffled_for_a_lookup(spark):
    items, docs, skips = tables(spark)
    rows = prompts.filled_prompts(items, docs, skips, broadcast_limit=0)
    before = prompts.filled_prompts(items, docs, skips)
    assert sorted(map(str, rows.collect())) == sorted(map(str, before.collect()))
    # documents are shuffled to their items, and those of case_1 to be made examples
    fresh = prompts.filled_prompts(items, docs, skips, broadcast_limit=0)
    mode = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    steps = mode.explainString(fresh._jdf.queryExecution(), "formatted").split("\n\n")
    wide = [s for s in steps if " Exchange\n" in s and "content#" in s]
    assert len(wide) == 2
