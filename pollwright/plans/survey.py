"""Queries over survey answers, survey texts and model exchanges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.constants import FORMATS
from pollwright.functions import paths, text
from pollwright.functions.questions import with_question_type
from pollwright.operators import exchange, survey
from pollwright.plans import fixtures, oracle
from pollwright.plans.fixtures import MODELS, SEGMENTS, table
from pollwright.plans.oracle import DOCUMENTS, ITEMS, RESULTS, items as sql_list, text as sql_text
from pollwright.plans.registry import query
from pollwright.sources import documents, markdown, qa_items, results as result_files, turtle

CODE = f"substr('abcde', CAST(list_position({sql_list(SEGMENTS)}, c_mktsegment) AS INT), 1)"
ANSWERS = f"""answers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS respondent_id, CAST(NULL AS VARCHAR) AS q_group,
    'Segment' AS q_key, {CODE} AS value FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, 'Nation', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'Profile', 'Balance',
    CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) FROM customer WHERE c_custkey % 9 <> 0
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'Profile', 'Name',
    CASE WHEN c_custkey % 10 = 3 THEN '' ELSE c_name END FROM customer)"""


@query(
    "q1_answer_lookup",
    f"""WITH {ANSWERS}, asked AS (SELECT CAST(c_custkey AS VARCHAR) AS respondent_id, q_key
      FROM customer CROSS JOIN (SELECT unnest(['Balance', 'Name']) AS q_key))
    SELECT respondent_id, q_key, coalesce(nullif(value, ''), 'None') AS value
    FROM asked LEFT JOIN answers USING (respondent_id, q_key)""",
)
def q1(spark, sf_dir):
    asked = table(spark, sf_dir, "customer").select(
        F.lit("customers").alias("dataset"),
        F.col("c_custkey").cast("string").alias("respondent_id"),
        F.explode(F.array(F.lit("Balance"), F.lit("Name"))).alias("q_key"),
    )
    found = survey.answer_lookup(fixtures.answers(spark, sf_dir), asked)
    return found.select("respondent_id", "q_key", "value")


@query(
    "q2_answer_reverse_lookup",
    f"""WITH {ANSWERS}, criteria AS (SELECT 'nation ' || n_nationkey AS criterion, 'Nation' AS q_key,
      CAST(n_nationkey * 2 AS VARCHAR) AS value FROM nation)
    SELECT criterion, coalesce(respondent_id, 'None') AS respondent_id
    FROM criteria LEFT JOIN answers USING (q_key, value)""",
)
def q2(spark, sf_dir):
    criteria = table(spark, sf_dir, "nation").select(
        fixtures.text("nation ", F.col("n_nationkey")).alias("criterion"),
        F.lit("customers").alias("dataset"),
        F.lit("Nation").alias("q_key"),
        (F.col("n_nationkey") * 2).cast("string").alias("value"),
    )
    return survey.reverse_lookup(fixtures.answers(spark, sf_dir), criteria)


@query(
    "q3_conceptual_aggregation",
    """SELECT o_orderstatus, o_orderpriority, count(o_totalprice) AS n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS total,
    CAST(min(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS least,
    CAST(max(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS greatest
    FROM orders GROUP BY ALL""",
)
def q3(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    return survey.concept_summary(orders, ["o_orderstatus", "o_orderpriority"], "price").drop("mean")


@query(
    "q3_concept_count",
    f"""WITH {ANSWERS}, concepts AS (SELECT unnest(['goods', 'goods', 'homes', 'homes']) AS concept,
      'Segment' AS q_key, unnest(['a', 'e', 'c', 'd']) AS value)
    SELECT concept, count(*) AS n FROM answers JOIN concepts USING (q_key, value) GROUP BY concept""",
)
def q3_concepts(spark, sf_dir):
    pairs = [("goods", "a"), ("goods", "e"), ("homes", "c"), ("homes", "d")]
    rows = F.array(*(F.struct(F.lit(c).alias("concept"), F.lit(v).alias("value")) for c, v in pairs))
    concepts = spark.range(1).select(F.inline(rows)).withColumns(
        {"q_key": F.lit("Segment"), "dataset": F.lit("customers")}
    )
    return survey.concept_count(fixtures.answers(spark, sf_dir), concepts).drop("dataset")


@query(
    "q4_multi_hop_related",
    f"""WITH anchors AS (SELECT arg_max(c_custkey, (c_acctbal, c_custkey)) AS a FROM customer GROUP BY c_mktsegment),
    anchor AS (SELECT c_custkey AS a, c_nationkey AS n FROM customer WHERE c_custkey IN (SELECT a FROM anchors))
    SELECT CAST(a AS VARCHAR) AS anchor_id, CAST(c_custkey AS VARCHAR) AS respondent_id
    FROM customer JOIN anchor ON c_nationkey = n
    WHERE c_custkey <> a AND {CODE} = 'b'""",
)
def q4(spark, sf_dir):
    richest = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.max(F.struct("c_acctbal", "c_custkey"))["c_custkey"].cast("string").alias("respondent_id")
    )
    anchors = richest.select(F.lit("customers").alias("dataset"), "respondent_id")
    return survey.related_respondents(
        fixtures.answers(spark, sf_dir), anchors, ["Nation"], {"Segment": F.col("Segment") == "b"}
    ).drop("dataset")


@query(
    "q4_multi_hop_counts",
    """SELECT CAST(c_custkey AS VARCHAR) AS respondent_id,
    count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) - 1 AS related FROM customer""",
)
def q4_counts(spark, sf_dir):
    return survey.related_counts(fixtures.answers(spark, sf_dir), ["Nation", "Segment"]).drop("dataset")


@query(
    "q5_respondent_count",
    f"""WITH {ANSWERS} SELECT q_key, value, count(DISTINCT respondent_id) AS respondents
    FROM answers WHERE q_key IN ('Segment', 'Nation') GROUP BY ALL""",
)
def q5(spark, sf_dir):
    return survey.respondent_count(
        fixtures.answers(spark, sf_dir), F.col("q_key").isin("Segment", "Nation"), ["q_key", "value"]
    )


_RULES = lambda: [
    ("Segment", F.col("value").isin("a", "b")),
    ("Balance", F.col("value").try_cast("long") > 5000),
    ("Nation", F.col("value").try_cast("long") < 12),
]
_RULE_SQL = f"""({CODE} IN ('a', 'b'))::INT + (c_custkey % 9 <> 0 AND floor(c_acctbal) > 5000)::INT
    + (c_nationkey < 12)::INT"""


@query("q6_rule_based_all", f"SELECT CAST(c_custkey AS VARCHAR) AS respondent_id FROM customer WHERE {_RULE_SQL} = 3")
def q6_all(spark, sf_dir):
    return survey.rule_matches(fixtures.answers(spark, sf_dir), _RULES()).drop("dataset")


@query("q6_rule_based_any", f"SELECT CAST(c_custkey AS VARCHAR) AS respondent_id FROM customer WHERE {_RULE_SQL} >= 1")
def q6_any(spark, sf_dir):
    return survey.rule_matches(fixtures.answers(spark, sf_dir), _RULES(), at_least=1).drop("dataset")


@query(
    "q7_option_decode",
    f"""WITH {ANSWERS} SELECT respondent_id, upper(value) AS code,
    {sql_list(SEGMENTS)}[ascii(value) - 96] AS label FROM answers WHERE q_key = 'Segment'""",
)
def q7(spark, sf_dir):
    coded = fixtures.answers(spark, sf_dir).filter(F.col("q_key") == "Segment")
    labels = survey.option_labels(with_question_type(fixtures.questions(spark)))
    return survey.decode_options(coded, labels).select("respondent_id", "code", "label")


@query(
    "q8_multi_select",
    """WITH chosen AS (SELECT unnest(string_split(p_name || ' ' || p_type, ' ')) AS item FROM part)
    SELECT item, count(*) AS n FROM chosen GROUP BY item""",
)
def q8(spark, sf_dir):
    joined = F.concat_ws(" ", "p_name", "p_type")
    as_list = F.concat(F.lit("['"), F.replace(joined, F.lit(" "), F.lit("', '")), F.lit("']"))
    value = F.when(F.col("p_partkey") % 2 == 0, F.replace(joined, F.lit(" "), F.lit(";"))).otherwise(as_list)
    rows = table(spark, sf_dir, "part").select(value.alias("value"))
    return survey.explode_choices(rows).groupBy("item").agg(F.count("*").alias("n"))


@query(
    "q9_wide_view",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS respondent_id, {CODE} AS "Segment",
    CAST(c_nationkey AS VARCHAR) AS "Nation",
    CASE WHEN c_custkey % 9 <> 0 THEN CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS "Balance",
    CASE WHEN c_custkey % 10 = 3 THEN '' ELSE c_name END AS "Name" FROM customer""",
)
def q9(spark, sf_dir):
    keys = ["Segment", "Nation", "Balance", "Name"]
    return survey.wide_view(fixtures.answers(spark, sf_dir), keys).drop("dataset")


# --- survey texts: two respondents per customer ------------------------------

ANSWER_COLUMNS = ["respondent_id", "q_group", "q_key", "value"]


def _survey_answers(key_form: str) -> str:
    """The answers both text forms hold, straight from the table."""
    k = (lambda s: s.replace(" ", "_")) if key_form == "turtle" else (lambda s: s)
    first = [
        ("NULL", "Account Name", "c_name"),
        ("NULL", "Segment", "lower(c_mktsegment)"),
        ("NULL", "Notes", "'first line' || chr(10) || 'second; line of ' || c_custkey || '.'"),
        ("NULL", "Empty", "''"),
        (f"'{k('Money Matters')}'", "Balance", "CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)"),
        (f"'{k('Money Matters')}'", "Home Nation", "CAST(c_nationkey AS VARCHAR)"),
    ]
    rows = [
        f"SELECT CAST(c_custkey AS VARCHAR) AS respondent_id, CAST({g} AS VARCHAR) AS q_group,"
        f" '{k(q)}' AS q_key, {v} AS value FROM customer"
        for g, q, v in first
    ]
    rows.append(
        f"SELECT CAST(c_custkey + 1000000000 AS VARCHAR), NULL, '{k('Account Name')}', 'again ' || c_name FROM customer"
    )
    return " UNION ALL ".join(rows)


def _customer_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Column]]:
    customers = fixtures.spread(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    )
    key = F.col("c_custkey")
    return customers, {
        "id": key,
        "other": key + 1000000000,
        "name": F.col("c_name"),
        "segment": F.lower("c_mktsegment"),
        "balance": F.floor("c_acctbal"),
        "nation": F.col("c_nationkey"),
    }


MARKDOWN_FORM = """# Survey Data

## Questions

- **Account Name:** What is your name? [Open-ended]
- **Segment:** Which segment? [MCQ: A. One B. Two, e.g. B. Sc. C. Three]
- **Money Matters:** About money. [Likert 0–10: 0 = None, 10 = All]
  - **Balance:** Balance?

## Responses

### Respondent {id}

- **Account Name:** {name}
- **Segment:** {segment}
- **Notes:** first line
second; line of {id}.
- **Empty:** 
- **Money Matters:**
  - **Balance:** {balance}
  - **Home Nation:** {nation}

### Respondent {other}

- **Account Name:** again {name}
- **Money Matters:**
"""
TURTLE_FORM = """@prefix : <http://example.org/survey#> .

# Questions
:QAccount_Name pred:text "What is your name? [Open-ended]" .
:QGMoney_Matters pred:BaseQuestion "About money. [Likert 0–10: 0 = None, 10 = All]" ;
    qg:hasSubQuestion :QMoney_Matters_Balance, :QMoney_Matters_Home_Nation .
:QMoney_Matters_Balance pred:text "Balance?" .

# Responses
:Respondent{id} a :Person ;
    pred:Account_Name "{name}" ;
    pred:Segment "{segment}" ;
    pred:Notes "first line
second; line of {id}." ;
    pred:Empty ""  .

:Respondent{id}_Money_Matters
                 pred:Balance {balance} ;
                 pred:Home_Nation "{nation}"  .
:Respondent{id} pred:hasGroupResponse :Respondent{id}_Money_Matters .

:Respondent{other} pred:Account_Name "again {name}" .
"""


def survey_texts(spark: SparkSession, sf_dir: str, form: str, file_format: str) -> DataFrame:
    customers, parts = _customer_parts(spark, sf_dir)
    return customers.select(
        F.lit("customers").alias("dataset"),
        F.lit("answer_lookup").alias("task"),
        F.lit(file_format).alias("format"),
        fixtures.text("case_", F.col("c_custkey")).alias("case_id"),
        fixtures.fill(F.lit(form), **parts).alias("content"),
    )


@query("s9_markdown_answers", _survey_answers("markdown"))
def s9(spark, sf_dir):
    return markdown.answers(survey_texts(spark, sf_dir, MARKDOWN_FORM, "md")).select(*ANSWER_COLUMNS)


def _case_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of both text forms; every case holds the same two respondents of its customer."""
    both = markdown.answers(survey_texts(spark, sf_dir, MARKDOWN_FORM, "md")).unionByName(
        turtle.answers(survey_texts(spark, sf_dir, TURTLE_FORM, "ttl"))
    )
    return both.withColumn("respondent_id", (F.col("respondent_id").cast("long") % 11).cast("string"))


_CASES = "SELECT 'case_' || c_custkey AS case_id, c_custkey AS k, c_custkey + 1000000000 AS o, * FROM customer"
_CASE_KEY = ["dataset", "task", "case_id"]


@query(
    "q1_lookup_in_case",
    f"""WITH c AS ({_CASES}) SELECT case_id, CAST(k % 11 AS VARCHAR) AS respondent_id,
    lower(c_mktsegment) AS value FROM c""",
)
def q1_case(spark, sf_dir):
    answers = survey.of_cases(_case_answers(spark, sf_dir), "md")
    asked = answers.filter("q_key = 'Segment'").select(*_CASE_KEY, "respondent_id", "q_key").distinct()
    return survey.answer_lookup(answers, asked, survey.CASE).select("case_id", "respondent_id", "value")


@query(
    "q2_reverse_lookup_in_case",
    f"""WITH c AS ({_CASES}) SELECT case_id, CASE WHEN lower(c_mktsegment) = 'building'
    THEN CAST(k % 11 AS VARCHAR) ELSE 'None' END AS answer FROM c""",
)
def q2_case(spark, sf_dir):
    answers = survey.of_cases(_case_answers(spark, sf_dir), "ttl")
    # the questions asked of each case, which don't come from its text
    criteria = table(spark, sf_dir, "customer").select(
        F.lit("customers").alias("dataset"),
        F.lit("answer_lookup").alias("task"),
        fixtures.text("case_", F.col("c_custkey")).alias("case_id"),
    ).withColumns({"criterion": F.col("case_id"), "q_key": F.lit("Segment"), "value": F.lit("building")})
    found = survey.reverse_lookup(answers, criteria, survey.CASE)
    return survey.answer_text(found, ["criterion"]).withColumnRenamed("criterion", "case_id")


@query(
    "q5_count_in_case",
    f"""WITH c AS ({_CASES}) SELECT case_id, CAST(CASE WHEN k % 11 = o % 11 THEN 1 ELSE 2 END AS BIGINT)
    AS respondents FROM c""",
)
def q5_case(spark, sf_dir):
    answers = survey.of_cases(_case_answers(spark, sf_dir), "md")
    named = F.col("q_key") == "Account Name"
    return survey.respondent_count(answers, named, _CASE_KEY, survey.CASE).select("case_id", "respondents")


@query(
    "q3_q4_q6_in_case",
    f"""WITH c AS ({_CASES}) SELECT case_id, CAST(1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS related,
    c_acctbal >= 5000 AS rich FROM c""",
)
def q346_case(spark, sf_dir):
    answers = survey.of_cases(_case_answers(spark, sf_dir), "md")
    wanted = answers.filter("q_key = 'Segment'").select("dataset", "q_key", "value").distinct()
    counts = survey.concept_count(answers, wanted.withColumn("concept", F.lit("any")), survey.CASE)
    related = survey.related_counts(answers, ["Segment"], survey.CASE)
    rich = survey.rule_matches(answers, [("Balance", F.col("value").try_cast("long") >= 5000)], per=survey.CASE)
    flags = rich.select(*_CASE_KEY, F.lit(True).alias("rich"))
    return (
        counts.join(related, _CASE_KEY).join(flags, _CASE_KEY, "left")
        .select("case_id", "n", "related", F.coalesce("rich", F.lit(False)).alias("rich"))
    )


@query(
    "s9_markdown_questions",
    """SELECT 'case_' || c_custkey AS case_id, pos, q_group, q_key, q_type, options, lo, hi FROM customer
    CROSS JOIN (VALUES
      (0, NULL, 'Account Name', 'Open-ended', NULL, NULL, NULL),
      (1, NULL, 'Segment', 'MCQ', 'A=One|B=Two, e.g. B. Sc.|C=Three', NULL, NULL),
      (2, NULL, 'Money Matters', 'Likert', '0=None|10=All', 0, 10),
      (3, 'Money Matters', 'Balance', NULL, NULL, NULL, NULL))
      AS t(pos, q_group, q_key, q_type, options, lo, hi)""",
)
def s9_questions(spark, sf_dir):
    rows = with_question_type(markdown.questions(survey_texts(spark, sf_dir, MARKDOWN_FORM, "md")))
    return rows.select("case_id", "pos", "q_group", "q_key", "q_type", shown_options(), "lo", "hi")


def shown_options() -> Column:
    pairs = F.transform("options", lambda o: F.concat_ws("=", o["code"], o["label"]))
    return F.array_join(pairs, "|").alias("options")


@query("s10_turtle_answers", _survey_answers("turtle"))
def s10(spark, sf_dir):
    return turtle.answers(survey_texts(spark, sf_dir, TURTLE_FORM, "ttl")).select(*ANSWER_COLUMNS)


_NODE = "'Respondent' || c_custkey || '_Money_Matters'"


@query(
    "s10_turtle_triples",
    f"""SELECT 'Respondent' || c_custkey AS subject, 'a' AS predicate, 'Person' AS object FROM customer
    UNION ALL SELECT 'Respondent' || c_custkey, 'pred:Account_Name', c_name FROM customer
    UNION ALL SELECT 'Respondent' || c_custkey, 'pred:Segment', lower(c_mktsegment) FROM customer
    UNION ALL SELECT 'Respondent' || c_custkey, 'pred:Notes',
      'first line' || chr(10) || 'second; line of ' || c_custkey || '.' FROM customer
    UNION ALL SELECT 'Respondent' || c_custkey, 'pred:Empty', '' FROM customer
    UNION ALL SELECT {_NODE}, 'pred:Balance', CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) FROM customer
    UNION ALL SELECT {_NODE}, 'pred:Home_Nation', CAST(c_nationkey AS VARCHAR) FROM customer
    UNION ALL SELECT 'Respondent' || c_custkey, 'pred:hasGroupResponse', {_NODE} FROM customer
    UNION ALL SELECT 'Respondent' || (c_custkey + 1000000000), 'pred:Account_Name', 'again ' || c_name FROM customer
    UNION ALL SELECT s, p, o FROM customer CROSS JOIN (VALUES
      ('QAccount_Name', 'pred:text', 'What is your name? [Open-ended]'),
      ('QGMoney_Matters', 'pred:BaseQuestion', 'About money. [Likert 0–10: 0 = None, 10 = All]'),
      ('QGMoney_Matters', 'qg:hasSubQuestion', 'QMoney_Matters_Balance'),
      ('QGMoney_Matters', 'qg:hasSubQuestion', 'QMoney_Matters_Home_Nation'),
      ('QMoney_Matters_Balance', 'pred:text', 'Balance?')) AS t(s, p, o)""",
)
def s10_triples(spark, sf_dir):
    rows = turtle.triples(survey_texts(spark, sf_dir, TURTLE_FORM, "ttl"))
    return rows.select("subject", "predicate", "object")


@query(
    "s11_question_types",
    """SELECT p_partkey, 'What is ' || p_name || '?' AS q_text,
    CASE p_partkey % 4 WHEN 0 THEN 'MCQ' WHEN 1 THEN 'Likert' WHEN 2 THEN 'Rubric' ELSE 'Open-ended' END AS q_type,
    CASE p_partkey % 4 WHEN 0 THEN 'A=' || p_brand || '|B=' || p_type || ' (e.g. B. Sc.)|C=Other'
      WHEN 1 THEN '1=' || p_type || '|' || p_size || '=' || p_brand
      WHEN 2 THEN '0=' || p_type || '|' || p_size || '=' || p_brand || ', or more' END AS options,
    CASE p_partkey % 4 WHEN 1 THEN 1 WHEN 2 THEN 0 END AS lo,
    CASE WHEN p_partkey % 4 IN (1, 2) THEN p_size END AS hi FROM part""",
)
def s11(spark, sf_dir):
    forms = [
        "What is {n}? [MCQ: A. {b} B. {t} (e.g. B. Sc.) C. Other]",
        "What is {n}? [Likert 1–{s}: 1 = {t}, {s} = {b}]",
        "What is {n}? [Rubric: 0 = {t}, {s} = {b}, or more]",
        "What is {n}? [Open-ended]",
    ]
    label = fixtures.fill(
        fixtures.pick(forms, F.col("p_partkey") % 4),
        n=F.col("p_name"), b=F.col("p_brand"), t=F.col("p_type"), s=F.col("p_size"),
    )
    rows = with_question_type(table(spark, sf_dir, "part").select("p_partkey", label.alias("label")))
    return rows.select("p_partkey", "q_text", "q_type", shown_options(), "lo", "hi")


# --- files and paths ---------------------------------------------------------


@query(
    "s1_document_scan",
    f"""WITH {DOCUMENTS} SELECT dataset, task, format, case_id, md5(content) AS digest FROM docs
    WHERE format <> 'txt'""",
)
def s1(spark, sf_dir):
    docs = fixtures.survey_documents(spark, sf_dir)
    # Files whose ending is not their folder's format are not documents.
    ending = F.when(F.col("format") == "txt", "bak").otherwise(F.col("format"))
    path = F.concat(
        F.lit("file:/cache/"), F.concat_ws("/", "dataset", "task", "format", "case_id"), F.lit("."), ending
    )
    files = docs.select(path.alias("path"), "content").filter(paths.is_document(F.col("path")))
    keys = [c.alias(n) for n, c in paths.document_keys(F.col("path")).items()]
    return files.select(*keys, F.md5("content").alias("digest"))


@query(
    "s2_question_items",
    f"""WITH {ITEMS} SELECT pos, case_id, question, expected_answer, md5(prompt) AS prompt,
    'case_id,topic,question,expected_answer,prompt,attempts,request' AS keys,
    CAST(attempts AS VARCHAR) AS attempts, '[''a'', ' || attempts || ', True]' AS tags FROM items""",
)
def s2(spark, sf_dir):
    items = fixtures.question_items(spark, sf_dir)
    tags = F.concat(F.lit('["a",'), F.col("attempts"), F.lit(",true]"))
    objects = items.select(
        "dataset", "task", "pos",
        F.concat(
            F.rtrim(F.to_json(F.struct(*fixtures.ITEM_FIELDS)), F.lit("}")), F.lit(',"tags":'), tags, F.lit("}")
        ).alias("value"),
    )
    rows = qa_items.items_from_objects(objects)
    value = lambda k: F.get(F.filter("fields", lambda f: f["key"] == k), F.lit(0))["value"]
    keys = F.filter(F.transform("fields", lambda f: f["key"]), lambda k: k != "tags")
    return rows.select(
        "pos", "case_id", "question", "expected_answer", F.md5("prompt").alias("prompt"),
        F.array_join(keys, ",").alias("keys"), value("attempts").alias("attempts"), value("tags").alias("tags"),
    )


_RECORD_FILE = """case_id,task,question,questionnaire,expected_answer,prompt,Response,Correct
case_{n},{t},"Which, of {k}?",{{"a": [1, {k}], "b": "x,y"}},"{p}","say ""hi"", [q
next, line",  got {n}  ,True
case_{n}b,{t},short,only two
case_{n}c,unknown_task,q,{{}},e,p,r,False
case_{n}d,{t},q{k},"[1, 2]",{p}"""


def _broken_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A malformed result text per order."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    form = _RECORD_FILE.replace("{{", "{").replace("}}", "}")
    value = fixtures.fill(
        F.lit(form), n=k % 50 + 1, k=k, p=F.col("o_orderpriority"), t=fixtures.pick(fixtures.TASKS, k % 6)
    )
    return orders.select(k.alias("row_id"), value.alias("value"))


_RECOVERED = f"""keyed AS (SELECT o_orderkey AS row_id, o_orderkey AS k, 'case_' || (o_orderkey % 50 + 1) AS c,
    {sql_list(fixtures.TASKS)}[CAST(o_orderkey % 6 AS INT) + 1] AS task, o_orderpriority AS p FROM orders)"""


@query(
    "s5_recovered_records",
    f"""WITH {_RECOVERED} SELECT row_id, c AS case_id, task, 'Which, of ' || k || '?' AS question,
    '{{"a": [1, ' || k || '], "b": "x,y"}}' AS questionnaire, p AS expected_answer,
    'say "hi", [q' || chr(10) || 'next, line' AS prompt, 'got ' || (k % 50 + 1) AS "Response",
    'True' AS "Correct" FROM keyed
    UNION ALL SELECT row_id, c || 'd', task, 'q' || k, '[1, 2]', p, '', '', '' FROM keyed""",
)
def s5(spark, sf_dir):
    return result_files.recovered(_broken_texts(spark, sf_dir))


@query(
    "s4_headers_by_name",
    f"""WITH {_RECOVERED} SELECT row_id, c AS case_id, task, p AS "Response",
    CASE WHEN row_id % 4 = 2 THEN '' ELSE 'TRUE' END AS skip FROM keyed WHERE row_id % 4 <> 3
    UNION ALL SELECT row_id, c, task, 'got ' || p, '' FROM keyed WHERE row_id % 4 = 3""",
)
def s4_headers(spark, sf_dir):
    """File texts with columns in other orders, with more columns, and one that needs recovery."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    forms = [
        'task,case_id,skip,Response\n{t},case_{n},TRUE,"{p}"\n',
        'case_id,task,model,question,Response,Correct,skip\r\ncase_{n},{t},m1,"a\n""b""",{p},,TRUE\r\n',
        "case_id,response_time,task,Response\ncase_{n},1.5,{t},{p}\nnote,2,{t},{p}\n",
        'case_id ,task\n"\ncase_{n},{t},q,d,e,pr,got {p},True\n',
    ]
    value = fixtures.fill(
        fixtures.pick(forms, k % 4), n=k % 50 + 1, p=F.col("o_orderpriority"), t=fixtures.pick(fixtures.TASKS, k % 6)
    )
    files = orders.select(k.alias("row_id"), value.alias("value"))
    rows = result_files.rows_of(files)
    return rows.select("row_id", "case_id", "task", "Response", "skip")


@query(
    "s5_quarantined_records",
    f"""WITH {_RECOVERED} SELECT row_id, problem, count(*) AS n FROM keyed CROSS JOIN
    (SELECT unnest(['fewer than three fields', 'no known task']) AS problem) GROUP BY ALL""",
)
def s5_quarantine(spark, sf_dir):
    rows = result_files.parsed_records(_broken_texts(spark, sf_dir)).filter(F.col("problem").isNotNull())
    return rows.groupBy("row_id", "problem").agg(F.count("*").alias("n"))


@query(
    "s5d_unescape",
    """WITH q AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '"' || replace(text, '"', '""') || '"' ELSE text END AS t
      FROM documents)
    SELECT doc_id, replace(CASE WHEN starts_with(t, '"') AND ends_with(t, '"') AND length(t) >= 2
      THEN substr(t, 2, length(t) - 2) ELSE t END, '""', '"') AS text FROM q""",
)
def s5d(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    value = F.when(F.col("doc_id") % 2 == 0, quoted).otherwise(F.col("text"))
    return docs.select("doc_id", text.unescape_csv(value).alias("text"))


@query(
    "s6_result_files",
    f"""WITH {RESULTS} SELECT DISTINCT dataset, dir_task, format FROM results WHERE row_id % 7 < 5""",
)
def s6(spark, sf_dir):
    rows = fixtures.results(spark, sf_dir)
    ending = fixtures.pick(
        ["_{f}_converted_prompts.csv"] * 5 + ["_pdf_converted_prompts.csv", "_{f}.csv"], F.col("row_id") % 7
    )
    name = F.concat("dir_task", F.replace(ending, F.lit("{f}"), F.col("format")))
    path = F.concat(F.lit("file:/data/results/m0/"), F.concat_ws("/", "dataset", "dir_task"), F.lit("/"), name)
    files = rows.select(path.alias("_path")).distinct()
    return result_files.discover(files, "/data/results/m0").drop("_path")


@query("s7_catalogue", f"WITH {ITEMS} SELECT DISTINCT dataset, task FROM items")
def s7(spark, sf_dir):
    items = fixtures.question_items(spark, sf_dir)
    stem = F.concat("dataset", F.lit("_"), "task", F.lit(paths.ITEMS_SUFFIX))
    return documents.tasks_of(items.select("dataset", stem.alias("stem")))


@query(
    "t16_format_tag",
    f"""WITH names AS (SELECT page_id, {sql_list([*FORMATS, 'pdf'])}[CAST(page_id % 7 AS INT) + 1] AS f FROM pages)
    SELECT page_id, nullif(f, 'pdf') AS format FROM names""",
)
def t16(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    tag = fixtures.pick([*FORMATS, "pdf"], F.col("page_id") % 7)
    host = F.regexp_extract("url", r"//([^/]+)/", 1)
    name = F.concat(host, F.lit("_"), tag, F.lit("_converted_prompts.csv"))
    return pages.select("page_id", paths.format_tag(name).alias("format"))


# --- model requests and replies ----------------------------------------------

_MODEL = f"{sql_list(MODELS)}[CAST(conv_id % {len(MODELS)} AS INT) + 1]"


def _model() -> Column:
    return fixtures.pick(MODELS, F.col("conv_id") % len(MODELS))


def _payloads() -> str:
    cold = "0.0::DOUBLE"
    r1, llama = (
        f"{sql_text(form.split('{}')[0])} || text || {sql_text(form.split('{}')[1])}"
        for form in (exchange.DEEPSEEK_R1_FORM, exchange.LLAMA_FORM)
    )
    bodies = [
        "{'anthropic_version': 'bedrock-2023-05-31', 'max_tokens': 4000, 'messages': "
        "[{'role': 'user', 'content': [{'type': 'text', 'text': text}]}]}",
        "{'messages': [{'role': 'user', 'content': text}], 'max_tokens': 4000, 'temperature': %s}" % cold,
        "{'prompt': %s, 'max_tokens': 4000, 'temperature': %s, 'top_p': 1.0::DOUBLE}" % (r1, cold),
        "{'prompt': text, 'max_tokens': 4000, 'temperature': %s}" % cold,
        "{'messages': [{'role': 'user', 'content': [{'text': text}]}], 'inferenceConfig': "
        "{'max_new_tokens': 4000, 'temperature': %s}}" % cold,
        "{'prompt': %s, 'max_gen_len': 4000, 'temperature': %s}" % (llama, cold),
        "{'inputText': text, 'textGenerationConfig': {'maxTokenCount': 4000, 'temperature': %s}}" % cold,
        "{'prompt': text, 'max_tokens': 4000, 'temperature': %s}" % cold,
        "{'prompt': text, 'max_tokens': 4000}",
    ]
    return " ".join(f"WHEN {i} THEN CAST(to_json({b}) AS VARCHAR)" for i, b in enumerate(bodies))


@query(
    "m1_request_payload",
    f"""SELECT conv_id, turn, {_MODEL} AS model, CASE conv_id % {len(MODELS)} {_payloads()} END AS payload
    FROM conversations WHERE role = 'user'""",
)
def m1(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    payload = exchange.request_payload(F.col("model"), F.col("text"))
    return turns.select("conv_id", "turn", _model().alias("model"), "text").select(
        "conv_id", "turn", "model", payload.alias("payload")
    )


REPLIES = [
    '{"content":[{"type":"text","text":@}]}',
    '{"choices":[{"message":{"content":@}}]}',
    '{"choices":[{"text":@}]}',
    '{"generation":@}',
    '{"output":{"message":{"content":[{"text":@}]}}}',
    '{"generation":@}',
    '{"results":[{"outputText":@}]}',
    '{"outputs":[{"text":@}]}',
    '{"anything":@}',
]


def _raw_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as model replies; every eleventh turn's is an empty object."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    as_json = F.regexp_extract(F.to_json(F.struct(F.concat(F.lit("  "), "text").alias("t"))), r"(?s)\A\{\"t\":(.*)\}\z", 1)
    reply = F.replace(fixtures.pick(REPLIES, F.col("conv_id") % len(MODELS)), F.lit("@"), as_json)
    lost = (F.col("conv_id") + F.col("turn")) % 11 == 0
    return turns.select(
        "conv_id", "turn", _model().alias("model"), F.when(lost, "{}").otherwise(reply).alias("reply")
    )


_STRIPPED = oracle.strip("text")
_REPLY_TEXT = f"""CASE WHEN (conv_id + turn) % 11 <> 0 THEN
    CASE WHEN conv_id % 9 = 8 THEN '{{"anything":' || CAST(to_json('  ' || text) AS VARCHAR) || '}}' ELSE {_STRIPPED} END
  WHEN conv_id % 9 IN (0, 4, 6) THEN NULL WHEN conv_id % 9 IN (1, 8) THEN '{{}}' ELSE '' END"""


@query(
    "m2_reply_text",
    f"SELECT conv_id, turn, {_REPLY_TEXT} AS response FROM conversations WHERE role = 'assistant'",
)
def m2(spark, sf_dir):
    rows = _raw_replies(spark, sf_dir)
    return rows.select("conv_id", "turn", exchange.reply_text(F.col("model"), F.col("reply")).alias("response"))


@query(
    "m3_envelope",
    """SELECT event_id, CASE WHEN event_type = 'error' OR event_id % 10 = 7 THEN '' ELSE trim(props) END AS response,
    event_type <> 'error' AND event_id % 10 <> 7 AS success,
    CASE WHEN event_type = 'error' THEN 'HTTP error at ' || event_id
      WHEN event_id % 10 = 7 THEN 'reply lacks its text' END AS error, value AS response_time FROM events""",
)
def m3(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    failed = F.when(F.col("event_type") == "error", fixtures.text("HTTP error at ", F.col("event_id")))
    reply = F.when(F.col("event_id") % 10 != 7, text.strip(F.col("props")))
    outcome = exchange.envelope(reply, failed, F.col("value"))
    return events.select("event_id", outcome.alias("e")).select("event_id", "e.*")
