"""Survey-shaped tables derived from the given tables.

The given tables hold no surveys, so each query starts from one of these
frames. They are row-wise expressions over whole tables (only
:func:`question_items` groups a turn with its reply), so their work grows with
the tables. ``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.constants import FORMATS, SECTIONS, TASKS

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

MODELS = [
    "us.anthropic.claude-3-haiku-v1:0",
    "qwen.qwen3-32b-v1:0",
    "us.deepseek.r1-v1:0",
    "deepseek.v3-v1:0",
    "amazon.nova-pro-v1:0",
    "us.meta.llama3-3-70b-instruct-v1:0",
    "amazon.titan-text-express-v1",
    "mistral.mistral-large-2402-v1:0",
    "plain-text-model",
]

#: Tasks of rows that are dealt over the cores.
TASKS_A_CORE = 4

TEMPLATE = {
    "example": "<example>\n[CASE_1]\n</example>\n\n",
    "questionnaire": "<questionnaire>\n[Insert the full data block here]\n</questionnaire>\n\n",
    "role": "<role>\nYou study surveys about [TOPIC].\n</role>\n\n",
    "format": "<format>\nAttempt [ATTEMPTS] at [CASE_ID].\n</format>\n\n\n\n",
    "request": "<request>\n[REQUEST]\n</request>\n\n",
    "output": "<output>\nAnswer only.\n</output>\n\n",
    "task": "<task>\n[question]\n</task>\n",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Deal narrow rows evenly over the cores, before each becomes a text to be parsed.

    A scan has at most a task for each row group, however much work a row makes.
    """
    return rows.repartition(TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def pick(values: list[str], index: Column) -> Column:
    """``values[index]`` for a zero-based index column."""
    return F.element_at(F.array(*map(F.lit, values)), index.cast("int") + 1)


def text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def fill(template: Column, **values: Column) -> Column:
    """Replace ``{name}`` by each value in turn."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value.cast("string"))
    return template


EXPECTED = [
    "{a}", "['{a}', '{b}']", '["{a}", "{b}"]', "\"['{a}', '{b}']\"", "{a}, {b}", "None",
    "{p}", "", "[]", "{a}.5", "[x{a}, y{b}]",
]
RESPONSES = [
    "{e}",
    "{b}, {a}",
    "Respondent{a} and Respondent{b}",
    "{a}, {b}, {s}",
    "   ",
    " None ",
    "### ANALYSIS ###\nlooked at 12 rows\n### ANSWER ###\n{a}, {b}\n### END ###",
    "### answer ### {a}",
    '"{a}"',
    "The answer is {a}  because order {k}\tsays {q}",
    "A{a}",
    "HOSP_{a} case_{b}",
    "no match",
    "### ANSWER ###  ### END ###",
]


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored-answer rows, one per order, covering every answer shape."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    k, c, priority = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    a, b = F.col("a"), F.col("b")
    task = pick(TASKS, k % 6)
    number = k % 50 + 1
    empty_section = (k % 13 == 6) & (k % 4 == 0)
    expected = fill(pick(EXPECTED, k % 11), a=a, b=b, p=priority)
    response = fill(
        pick(RESPONSES, F.when(empty_section, 13).otherwise(k % 13)),
        a=a, b=b, k=k, s=a + b + 100, q=F.lower(priority), e=F.col("expected_answer"),
    )
    skip = (
        F.when(k % 17 == 0, "TRUE")
        .when(k % 17 == 1, " true ")
        .when(k % 17 == 2, "FALSE")
        .when(k % 17 == 3, F.lit(None).cast("string"))
        .otherwise("")
    )
    return (
        orders.withColumns({"a": k % 90 + 1, "b": c % 90 + 1})
        .withColumn("expected_answer", expected)
        .select(
            k.alias("row_id"),
            text("m", c % 3).alias("model"),
            text("ds", c % 5).alias("dataset"),
            task.alias("dir_task"),
            F.when((k % 101 == 0) & ((k / 101).cast("long") % 2 == 0), "free_form_probe")
            .when(k % 101 == 0, text("  ", F.upper(task), " "))
            .otherwise(task)
            .alias("task"),
            pick(FORMATS, (k / 6).cast("long") % 6).alias("format"),
            F.when(k % 97 == 0, text("item_", number))
            .when(k % 89 == 0, text(" case_", number, " "))
            .otherwise(text("case_", number))
            .alias("case_id"),
            text("Which respondents match order ", k, "?").alias("question"),
            "expected_answer",
            response.alias("Response"),
            pick(["True", "False", ""], k % 3).alias("Correct"),
            skip.alias("skip"),
        )
    )


def document_keys(doc_id: Column) -> dict[str, Column]:
    """Dataset, task and case together identify one document."""
    return {
        "dataset": text("ds", doc_id % 5),
        "task": pick(TASKS, doc_id % 6),
        "case_id": text("case_", (doc_id / 30).cast("long") + 1),
    }


def survey_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document in all formats but one; every seventh has all six."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    keys = document_keys(F.col("doc_id"))
    formats = F.posexplode(F.array(*map(F.lit, FORMATS))).alias("i", "format")
    return (
        docs.select("doc_id", "text", formats)
        .filter(F.col("doc_id") % 7 != F.col("i"))
        .select(
            keys["dataset"].alias("dataset"),
            keys["task"].alias("task"),
            "format",
            keys["case_id"].alias("case_id"),
            text("[", F.col("format"), " export]\n", F.col("text")).alias("content"),
        )
    )


def skip_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    toxic = table(spark, sf_dir, "labels").filter(F.col("toxic") == 1)
    keys = document_keys(F.col("doc_id"))
    return toxic.select(*(keys[c].alias(c) for c in ("dataset", "task", "case_id")))


def question_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question item per user turn; the turn after it is the expected answer."""
    is_user = F.col("role") == "user"
    turns = table(spark, sf_dir, "conversations").filter(F.col("role").isin("user", "assistant"))
    paired = (
        turns.groupBy("conv_id", F.when(is_user, F.col("turn")).otherwise(F.col("turn") - 1).alias("turn"))
        .agg(F.max(F.when(is_user, F.col("text"))).alias("text"), F.max(F.when(~is_user, F.col("text"))).alias("reply"))
        .filter(F.col("text").isNotNull())
    )
    n = F.col("conv_id")
    keys = document_keys(n)
    template = F.concat(
        *(
            F.when(n % 8 == i, "")
            .when((F.lit(name == "task")) & (n % 3 == 0), TEMPLATE[name].replace("[question]", "[QUESTION]"))
            .otherwise(TEMPLATE[name])
            for i, name in enumerate(SECTIONS)
        )
    )
    question = F.concat(
        F.col("text"), F.when(n % 5 == 0, " (see [TOPIC] in [questionnaire])").otherwise("")
    )
    return paired.select(
        keys["dataset"].alias("dataset"),
        keys["task"].alias("task"),
        (n * 1000 + F.col("turn")).alias("pos"),
        keys["case_id"].alias("case_id"),
        text("topic-", n % 4).alias("topic"),
        question.alias("question"),
        F.coalesce("reply", F.lit("")).alias("expected_answer"),
        template.alias("prompt"),
        F.col("turn").alias("attempts"),
        text("Focus on [TOPIC].").alias("request"),
    )


ITEM_FIELDS = ["case_id", "topic", "question", "expected_answer", "prompt", "attempts", "request"]


def keyed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question items in the shape :func:`sources.qa_items.read_items` gives."""
    items = question_items(spark, sf_dir)
    fields = F.array(
        *(
            F.struct(
                F.lit(f).alias("key"),
                F.col(f).cast("string").alias("value"),
                F.lit(f != "attempts").alias("is_text"),
            )
            for f in ITEM_FIELDS
        )
    )
    return items.select(
        "dataset", "task", "pos", "case_id", "question", "expected_answer", "prompt",
        fields.alias("fields"),
    )


def segment_code(segment: Column) -> Column:
    position = F.array_position(F.array(*map(F.lit, SEGMENTS)), segment).cast("int")
    return F.substring(F.lit("abcde"), position, F.lit(1))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as respondents, one row per answered question."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    entries = F.array(
        _entry(None, "Segment", segment_code(F.col("c_mktsegment"))),
        _entry(None, "Nation", F.col("c_nationkey").cast("string")),
        _entry("Profile", "Balance", F.when(key % 9 != 0, F.floor("c_acctbal").cast("string"))),
        _entry("Profile", "Name", F.when(key % 10 == 3, "").otherwise(F.col("c_name"))),
    )
    return (
        c.select(key.cast("string").alias("respondent_id"), F.inline(entries))
        .filter(F.col("value").isNotNull())
        .select(F.lit("customers").alias("dataset"), "respondent_id", "q_group", "q_key", "value")
    )


def _entry(group: str | None, key: str, value: Column) -> Column:
    return F.struct(
        F.lit(group).cast("string").alias("q_group"), F.lit(key).alias("q_key"), value.alias("value")
    )


def questions(spark: SparkSession) -> DataFrame:
    """The answer fixture's one coded question, as its options read in a survey."""
    options = " ".join(f"{chr(65 + i)}. {s}" for i, s in enumerate(SEGMENTS))
    return spark.range(1).select(
        F.lit("customers").alias("dataset"),
        F.lit(None).cast("string").alias("q_group"),
        F.lit("Segment").alias("q_key"),
        F.lit(f"What is your segment? [MCQ: {options}]").alias("label"),
    )
