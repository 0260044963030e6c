"""Queries over scored result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.functions import answers, text
from pollwright.operators import evaluate, filters, report, sinks
from pollwright.plans import fixtures, oracle
from pollwright.plans.oracle import CELLS, PARSED, RESULTS, SCORED, strip
from pollwright.plans.registry import query

FILE_KEYS = ["model", "dataset", "dir_task", "format"]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.score(filters.valid_cases(fixtures.results(spark, sf_dir)))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.accuracy(scored(spark, sf_dir))


def parsed(rows: DataFrame) -> DataFrame:
    return answers.with_items(rows, F.col("expected_answer"), "is_list", "items")


def _rule(task: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = evaluate.apply_rule(fixtures.results(spark, sf_dir), task)
        return rows.select("row_id", "is_correct")

    return run


SAME = oracle.one_rule(oracle.same_identifiers("clean"))
NUMBER = oracle.one_rule(oracle.names_number('"Response"'))

for _name, _task, _sql in (
    ("e1_rule_based_query", "rule_based_querying", SAME),
    ("e2_answer_reverse_lookup", "answer_reverse_lookup", SAME),
    ("e3_multi_hop_inference", "multi_hop_relational_inference", SAME),
    ("e4_answer_lookup", "answer_lookup", oracle.one_rule(oracle.contains_text("clean"))),
    ("e5_conceptual_aggregation", "conceptual_aggregation", NUMBER),
    ("e6_respondent_count", "respondent_count", NUMBER),
):
    query(_name, _sql)(_rule(_task))


@query(
    "e7_smart_evaluate",
    f"WITH {SCORED} SELECT row_id, task, is_correct FROM scored",
)
def e7(spark, sf_dir):
    return evaluate.score(fixtures.results(spark, sf_dir)).select("row_id", "task", "is_correct")


FLAGS = """CASE WHEN skipped THEN "Correct" WHEN is_correct THEN 'True' ELSE 'False' END"""


@query(
    "e8_correct_flag_update",
    f"""WITH {SCORED} SELECT row_id, {FLAGS} AS "Correct",
    {FLAGS} IS DISTINCT FROM "Correct" AS changed FROM scored""",
)
def e8(spark, sf_dir):
    rows = evaluate.score(fixtures.results(spark, sf_dir))
    return evaluate.update_flags(rows).select("row_id", "Correct", "changed")


@query(
    "k4_scored_results",
    f"""WITH {SCORED} SELECT model, dataset, format, case_id, task, question, expected_answer,
    "Response", {FLAGS} AS "Correct", skip FROM scored""",
)
def k4(spark, sf_dir):
    rows = evaluate.update_flags(evaluate.score(fixtures.results(spark, sf_dir)))
    return rows.select(
        "model", "dataset", "format", "case_id", "task", "question", "expected_answer",
        "Response", "Correct", "skip",
    )


_EDITED = "row_id % 499 = 7"


@query(
    "k4_changed_folders",
    f"""WITH {SCORED},
    edited AS (SELECT *, CASE WHEN {_EDITED} THEN 'edited' ELSE {FLAGS} END AS old FROM scored),
    again AS (SELECT *, CASE WHEN skipped THEN old WHEN is_correct THEN 'True' ELSE 'False' END AS flag,
      bool_or(NOT skipped AND {_EDITED}) OVER (PARTITION BY model, dataset, dir_task, format) AS rewritten
      FROM edited)
    SELECT row_id, model, dataset, dir_task, format, flag AS "Correct", skip FROM again WHERE rewritten""",
)
def k4_changed(spark, sf_dir):
    """Folders to write anew after some flags of a scored table were edited."""
    rows = evaluate.update_flags(evaluate.score(fixtures.results(spark, sf_dir))).drop("changed")
    flag = F.when(F.expr(_EDITED), "edited").otherwise(F.col("Correct"))
    again = evaluate.update_flags(rows.withColumn("Correct", flag))
    return sinks.changed_folders(again, FILE_KEYS).select("row_id", *FILE_KEYS, "Correct", "skip")


@query("f1_valid_cases", f"WITH {RESULTS} SELECT * FROM results WHERE starts_with({strip('case_id')}, 'case_')")
def f1(spark, sf_dir):
    return filters.valid_cases(fixtures.results(spark, sf_dir))


@query(
    "f2_not_skipped",
    f"""WITH {RESULTS} SELECT row_id, skip FROM results
    WHERE coalesce(upper({strip('skip')}), '') <> 'TRUE'""",
)
def f2(spark, sf_dir):
    return filters.not_skipped(fixtures.results(spark, sf_dir)).select("row_id", "skip")


@query(
    "f3_blank_responses_count_as_wrong",
    f"""WITH {SCORED} SELECT format, count(*) AS total,
    count(*) FILTER ({oracle.blank('"Response"')}) AS blank,
    count(*) FILTER ({oracle.blank('"Response"')} AND is_correct) AS blank_correct
    FROM scored GROUP BY format""",
)
def f3(spark, sf_dir):
    blank = text.is_blank(F.col("Response"))
    return evaluate.score(fixtures.results(spark, sf_dir)).groupBy("format").agg(
        F.count("*").alias("total"),
        F.count_if(blank).alias("blank"),
        F.count_if(blank & F.col("is_correct")).alias("blank_correct"),
    )


@query(
    "f5_slice",
    f"""WITH {RESULTS} SELECT row_id, model, dataset, dir_task, format FROM results
    WHERE model = 'm1' AND dataset = 'ds2' AND dir_task = 'respondent_count' AND format = 'ttl'""",
)
def f5(spark, sf_dir):
    rows = filters.in_slice(
        fixtures.results(spark, sf_dir),
        model="m1", dataset="ds2", dir_task="respondent_count", format="ttl",
    )
    return rows.select("row_id", "model", "dataset", "dir_task", "format")


@query(
    "f6_case_window",
    f"""WITH {RESULTS},
    numbered AS (SELECT *, CAST(regexp_extract({strip('case_id')}, '([0-9]+)$', 1) AS BIGINT) AS case_no
      FROM results),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY model, dataset, dir_task, format
      ORDER BY case_no, row_id) AS r FROM numbered WHERE case_no >= 2)
    SELECT row_id, model, dataset, dir_task, format, case_no FROM ranked WHERE r <= 5""",
)
def f6(spark, sf_dir):
    rows = filters.case_window(
        fixtures.results(spark, sf_dir), FILE_KEYS, ["row_id"], start_case=2, max_cases=5
    )
    return rows.select("row_id", *FILE_KEYS, "case_no")


@query("s4_result_scan", f"""WITH {RESULTS} SELECT row_id, task, coalesce("Response", '') AS "Response",
    coalesce(skip, '') AS skip FROM results WHERE starts_with({strip('case_id')}, 'case_')""")
def s4(spark, sf_dir):
    rows = filters.valid_cases(fixtures.results(spark, sf_dir))
    return rows.select("row_id", "task", "Response", "skip").na.fill("")


@query("s8_models", f"WITH {RESULTS} SELECT DISTINCT model FROM results ORDER BY model")
def s8(spark, sf_dir):
    return report.distinct_sorted(fixtures.results(spark, sf_dir), "model")


@query("t12_answer_section", f"""WITH {RESULTS} SELECT row_id, {oracle.section('"Response"')} AS answer FROM results""")
def t12(spark, sf_dir):
    rows = fixtures.results(spark, sf_dir)
    return rows.select("row_id", answers.answer_section(F.col("Response")).alias("answer"))


@query("t13_normalise", f"SELECT doc_id, {oracle.normalise('text')} AS clean FROM documents")
def t13(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.normalise(F.col("text")).alias("clean"))


@query(
    "t14_parse_expected",
    f"""WITH {PARSED} SELECT row_id, is_list, len(items) AS n_items,
    array_to_string(items, '|') AS items FROM parsed""",
)
def t14(spark, sf_dir):
    rows = parsed(fixtures.results(spark, sf_dir))
    return rows.select(
        "row_id",
        "is_list",
        F.size("items").alias("n_items"),
        F.array_join("items", "|").alias("items"),
    )


#: Nested expected answers, what their items print as, by the order's number.
_NESTED = [
    ("[['{a}', \"{b}\"], ['{a}',],]", ["['{a}', '{b}']", "['{a}']"]),
    ("[{'q': [{a},{b}], \"it's\": None}, '{p}']", ["{'q': [{a}, {b}], \"it's\": None}", "{p}"]),
    ("[({a}.50,), (({b})), [[]], {}]", ["({a}.5,)", "{b}", "[[]]", "{}"]),
    ('"[[true, {"b": null}], {a}]"', ["[True, {'b': None}]", "{a}"]),
    ("[[{a}, {b}], [{a}]", ["[[{a}", "{b}]", "[{a}]"]),
    ("[{a}], [{b}, [{a}]]", ["[{a}]", "[{b}, [{a}]]"]),
]


def _filled(value: str) -> str:
    """SQL for a pattern with the order's values in it."""
    out = oracle.text(value)
    for name in ("a", "b", "p"):
        out = f"replace({out}, '{{{name}}}', {name})"
    return out


_SHAPES = " ".join(f"WHEN {i} THEN [{', '.join(map(_filled, found))}]" for i, (_, found) in enumerate(_NESTED))


@query(
    "t14_nested_expected",
    f"""WITH v AS (SELECT o_orderkey, CAST(o_orderkey % 90 + 1 AS VARCHAR) AS a,
      CAST(o_custkey % 90 + 1 AS VARCHAR) AS b, o_orderpriority AS p FROM orders),
    i AS (SELECT o_orderkey, CASE o_orderkey % {len(_NESTED)} {_SHAPES} END AS items FROM v)
    SELECT o_orderkey, true AS is_list, len(items) AS n_items, array_to_string(items, '|') AS items FROM i""",
)
def t14_nested(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("p"),
        (F.col("o_orderkey") % 90 + 1).alias("a"), (F.col("o_custkey") % 90 + 1).alias("b"),
    )
    shape = fixtures.pick([text for text, _ in _NESTED], F.col("o_orderkey") % len(_NESTED))
    named = orders.withColumn("expected_answer", fixtures.fill(shape, a=F.col("a"), b=F.col("b"), p=F.col("p")))
    return parsed(named).select(
        "o_orderkey", "is_list", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items")
    )


_NAMED = """s_name || ' case_' || s_suppkey || ' A' || (s_nationkey + 1) || ' HOSP_' || s_nationkey
    || ' Respondent' || s_suppkey || ' ' || s_acctbal || ' b7 A' || (s_nationkey + 1)"""


@query(
    "t15_identifiers",
    f"""WITH named AS (SELECT s_suppkey, {_NAMED} AS t FROM supplier),
    found AS (SELECT s_suppkey, regexp_extract_all(t, '\\b\\d+\\b') || regexp_extract_all(t, '(?i)\\bcase_\\d+\\b')
      || regexp_extract_all(t, '\\b[A-Za-z]\\d+\\b') || regexp_extract_all(t, '\\b[A-Za-z]+_\\d+\\b')
      || regexp_extract_all(t, '\\b[A-Za-z]+(\\d+)\\b', 1) AS f FROM named),
    spread AS (SELECT s_suppkey, unnest(f) AS v, generate_subscripts(f, 1) AS p FROM found),
    firsts AS (SELECT s_suppkey, v, min(p) AS p FROM spread GROUP BY ALL)
    SELECT s_suppkey, string_agg(v, ' ' ORDER BY p) AS identifiers FROM firsts GROUP BY s_suppkey""",
)
def t15(spark, sf_dir):
    suppliers = fixtures.table(spark, sf_dir, "supplier")
    named = F.expr(_NAMED)
    return suppliers.select(
        "s_suppkey", F.array_join(answers.identifiers(named), " ").alias("identifiers")
    )


@query("a1_accuracy", f"WITH {CELLS} SELECT * FROM cells")
def a1(spark, sf_dir):
    return cells(spark, sf_dir)


@query(
    "a1_last_file_of_a_key",
    f"""WITH {SCORED}, files AS (SELECT dataset, dir_task, format, model,
      count(*) FILTER (NOT skipped AND is_correct) AS correct, count(*) FILTER (NOT skipped) AS total
      FROM scored WHERE starts_with({strip('case_id')}, 'case_') GROUP BY ALL),
    lasts AS (SELECT *, row_number() OVER (PARTITION BY dataset, dir_task, format ORDER BY model DESC) AS r FROM files)
    SELECT dataset, dir_task, format, correct, total, {oracle.PCT} AS percentage FROM lasts WHERE r = 1""",
)
def a1_last(spark, sf_dir):
    """Each model's rows as one file of the same key: the last one stands."""
    return report.accuracy(scored(spark, sf_dir), file="model")


@query("a2_count_table", oracle.pivoted("CAST(c AS BIGINT) || '/' || CAST(t AS BIGINT)"))
def a2(spark, sf_dir):
    return report.count_table(cells(spark, sf_dir))


@query("a3_percentage_table", oracle.pivoted("printf('%.1f%%', c / t * 100)"))
def a3(spark, sf_dir):
    return report.percentage_table(cells(spark, sf_dir))


COUNTS, SHARES = "CAST(c AS BIGINT) || '/' || CAST(t AS BIGINT)", "printf('%.1f%%', c / t * 100)"
_RELABELLED = f"""WITH {CELLS.replace('cells AS (SELECT', 'old_cells AS (SELECT')},
cells AS (SELECT * REPLACE (CASE WHEN dataset = 'ds1' THEN 'new_task' ELSE dir_task END AS dir_task)
    FROM old_cells)"""


@query("a2_task_never_seen_before", oracle.pivoted(COUNTS, cells=_RELABELLED, tasks=[*oracle.TASKS, "new_task"]))
def a2_new_task(spark, sf_dir):
    task = F.when(F.col("dataset") == "ds1", "new_task").otherwise(F.col("dir_task"))
    return report.count_table(cells(spark, sf_dir).withColumn("dir_task", task))


_BY_MODEL = f"WITH {CELLS.replace('SELECT dataset, dir_task', 'SELECT model, dataset, dir_task')}"


@query("a3_percentages_per_model", oracle.pivoted(SHARES, cells=_BY_MODEL, by="model"))
def a3_models(spark, sf_dir):
    found = report.accuracy(scored(spark, sf_dir), ["model", *report.GROUP])
    return report.percentage_table(found, by=["model"])


@query(
    "a1_report_levels_per_model",
    f"""{_BY_MODEL}, s AS (SELECT model, dataset, dir_task, format, CAST(sum(correct) AS BIGINT) AS correct,
    CAST(sum(total) AS BIGINT) AS total, CAST(grouping(model, dataset, dir_task, format) AS BIGINT) AS level
    FROM cells GROUP BY GROUPING SETS ((model, dataset, dir_task, format), (model, dir_task), (model)))
    SELECT *, {oracle.PCT} AS percentage FROM s""",
)
def a1_models(spark, sf_dir):
    found = report.accuracy(scored(spark, sf_dir), ["model", *report.GROUP])
    return report.report_levels(found, ["model"])


_FRAME = 'SELECT * RENAME (format AS "Format") FROM'


@query(
    "k5_report_files",
    f"""SELECT 'counts' AS file, * FROM ({_FRAME} ({oracle.pivoted(COUNTS)}))
    UNION ALL SELECT 'percentages', * FROM ({_FRAME} ({oracle.pivoted(SHARES)}))""",
)
def k5(spark, sf_dir):
    found = cells(spark, sf_dir)
    named = [("counts", report.count_table(found)), ("percentages", report.percentage_table(found))]
    frames = [sinks.report_frame(t).select(F.lit(n).alias("file"), "*") for n, t in named]
    return frames[0].unionByName(frames[1])


@query(
    "a4_grand_total",
    f"""WITH {CELLS}, s AS (SELECT CAST(sum(correct) AS BIGINT) AS correct,
    CAST(sum(total) AS BIGINT) AS total FROM cells) SELECT *, {oracle.PCT} AS percentage FROM s""",
)
def a4(spark, sf_dir):
    return report.summarise(cells(spark, sf_dir))


@query(
    "a5_accuracy_by_task",
    f"""WITH {CELLS}, s AS (SELECT dir_task, CAST(sum(correct) AS BIGINT) AS correct,
    CAST(sum(total) AS BIGINT) AS total FROM cells GROUP BY dir_task)
    SELECT *, {oracle.PCT} AS percentage FROM s ORDER BY dir_task""",
)
def a5(spark, sf_dir):
    return report.summarise(cells(spark, sf_dir), "dir_task").orderBy("dir_task")


@query(
    "a1_a4_a5_report_levels",
    f"""WITH {CELLS}, s AS (SELECT dataset, dir_task, format, CAST(sum(correct) AS BIGINT) AS correct,
    CAST(sum(total) AS BIGINT) AS total, CAST(grouping(dataset, dir_task, format) AS BIGINT) AS level
    FROM cells GROUP BY GROUPING SETS ((dataset, dir_task, format), (dir_task), ()))
    SELECT *, {oracle.PCT} AS percentage FROM s""",
)
def a145(spark, sf_dir):
    return report.report_levels(cells(spark, sf_dir))


@query("a6_datasets_and_tasks", f"WITH {RESULTS} SELECT DISTINCT dataset, dir_task FROM results ORDER BY ALL")
def a6(spark, sf_dir):
    return report.distinct_sorted(fixtures.results(spark, sf_dir), "dataset", "dir_task")


@query(
    "a7_volume",
    f"""WITH {RESULTS} SELECT count(DISTINCT (model, dataset, dir_task, format)) AS files,
    count(*) AS records FROM results""",
)
def a7(spark, sf_dir):
    return report.volume(fixtures.results(spark, sf_dir), FILE_KEYS)


_FOUND = oracle.identifier_set('"Response"')


@query(
    "a8_set_equality_and_membership",
    f"""WITH {PARSED} SELECT row_id,
    list_sort({_FOUND}) = list_sort(list_distinct(items)) AS same_set,
    list_contains({_FOUND}, items[1]) AS holds_first FROM parsed""",
)
def a8(spark, sf_dir):
    found = answers.identifier_set(F.col("Response"))
    rows = parsed(fixtures.results(spark, sf_dir)).select(
        "row_id", found.alias("f"), F.col("items").alias("i")
    )
    return rows.select(
        "row_id",
        (F.sort_array("f") == F.sort_array(F.array_distinct("i"))).alias("same_set"),
        F.array_contains("f", F.get("i", F.lit(0))).alias("holds_first"),
    )


@query(
    "a9_ordered_distinct",
    """WITH w AS (SELECT p_partkey, string_split(p_name || ' ' || p_brand || ' ' || p_name, ' ') AS l FROM part),
    spread AS (SELECT p_partkey, unnest(l) AS v, generate_subscripts(l, 1) AS p FROM w),
    firsts AS (SELECT p_partkey, v, min(p) AS p FROM spread GROUP BY ALL)
    SELECT p_partkey, string_agg(v, ' ' ORDER BY p) AS words FROM firsts GROUP BY p_partkey""",
)
def a9(spark, sf_dir):
    parts = fixtures.table(spark, sf_dir, "part")
    words = F.split(F.concat_ws(" ", "p_name", "p_brand", "p_name"), " ")
    return parts.select("p_partkey", F.array_join(F.array_distinct(words), " ").alias("words"))
