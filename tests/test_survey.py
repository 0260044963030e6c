from pyspark.sql import functions as F

from pollwright.functions.questions import with_question_type
from pollwright.operators import exchange, survey
from pollwright.plans import survey as plans
from pollwright.sources import markdown, turtle

MARKDOWN = """# Survey Data

## Questions

- **Blood Type:** What? [MCQ: A. A+ B. AB- C. O+]
- **Mood (daily):** How often? [Likert 0–4]
  - **Calm:** Calm?
  - **Tense:** Tense?

## Responses

### Respondent 7

- **Blood Type:** b
- **Comments:** 10:29 start
Second line; "quoted" - **not** a key
  indented tail
- **Mood (daily):**
  - **Calm:** 2.0
  - **Tense:** 0.0

### Respondent 12

- **Blood Type:** 
- **Comments:** ok
- **Mood (daily):**
"""
TURTLE = """@prefix : <http://example.org/survey#> .

# Questions
:QBlood_Type pred:Text "What? [MCQ: A. A+ B. AB- C. O+]" .
:QGMood_daily pred:BaseQuestion "How often? [Likert 0–4]" ;
    qg:hasSubQuestion :QMood_daily_Calm,
                      :QMood_daily_Tense .
:QMood_daily_Calm pred:Text "Calm?" .
:QMood_daily_Tense pred:Text "Tense?" .

# Responses
:Respondent7 a :Person ;
    pred:Blood_Type "b" ;
    pred:Comments "10:29 start
Second line; 'quoted' - **not** a key
  indented tail" .

:Respondent7_Mood_daily
                       pred:Calm 2.0 ;
                       pred:Tense 0.0  .
:Respondent7 pred:hasGroupResponse :Respondent7_Mood_daily .

:Respondent12 pred:Blood_Type "" ;
     pred:Comments "ok" .
"""
COLUMNS = ["respondent_id", "q_group", "q_key", "value"]


def document(spark, content, file_format):
    return spark.createDataFrame(
        [("d", "t", file_format, "case_1", content)],
        "dataset string, task string, format string, case_id string, content string",
    )


def test_both_forms_hold_the_same_answers(spark):
    md = markdown.answers(document(spark, MARKDOWN.replace('"quoted"', "'quoted'"), "md"))
    ttl = turtle.answers(document(spark, TURTLE, "ttl"))
    md = md.withColumns({c: turtle.turtle_key(F.col(c)) for c in ("q_group", "q_key")})
    got = {tuple(r) for r in md.select(*COLUMNS).collect()}
    assert got == {tuple(r) for r in ttl.select(*COLUMNS).collect()}
    assert got == {
        ("7", None, "Blood_Type", "b"),
        ("7", None, "Comments", "10:29 start\nSecond line; 'quoted' - **not** a key\n  indented tail"),
        ("7", "Mood_daily", "Calm", "2.0"),
        ("7", "Mood_daily", "Tense", "0.0"),
        ("12", None, "Blood_Type", ""),
        ("12", None, "Comments", "ok"),
    }


def test_both_forms_hold_the_same_questions(spark):
    def shown(rows):
        rows = with_question_type(rows)
        keys = [turtle.turtle_key(F.col(c)).alias(c) for c in ("q_group", "q_key")]
        return {tuple(r) for r in rows.select(*keys, "q_text", "q_type", F.to_json("options"), "lo", "hi").collect()}

    got = shown(markdown.questions(document(spark, MARKDOWN, "md")))
    assert got == shown(turtle.questions(document(spark, TURTLE, "ttl")))
    assert ("Mood_daily", "Calm", "Calm?", None, None, None, None) in got
    assert (None, "Mood_daily", "How often?", "Likert", "[]", 0, 4) in got


def options(spark, label):
    row = with_question_type(spark.createDataFrame([(label,)], "label string")).first()
    return row["q_type"], [tuple(o) for o in row["options"] or []], row["lo"], row["hi"]


def test_option_labels_may_look_like_options(spark):
    label = "Q [MCQ: A. Degree (A.A., A.S., etc.) B. Bachelor (B.A., B. Eng.) C. I don't D. x]"
    assert options(spark, label) == (
        "MCQ",
        [("A", "Degree (A.A., A.S., etc.)"), ("B", "Bachelor (B.A., B. Eng.)"), ("C", "I don't"), ("D", "x")],
        None,
        None,
    )
    assert options(spark, "Q [MCQ-Multi: 1. Male 2. Over 9. grade 3. x]")[1] == [
        ("1", "Male"), ("2", "Over 9. grade"), ("3", "x"),
    ]


def test_scales(spark):
    assert options(spark, "Q [Likert 1–6: 1 = Very low, 6 = Very, very high]") == (
        "Likert", [("1", "Very low"), ("6", "Very, very high")], 1, 6,
    )
    assert options(spark, "Q [Rubric: 0 = none, 1 = some, but few, 3 = all]")[1:] == (
        [("0", "none"), ("1", "some, but few"), ("3", "all")], 0, 3,
    )
    assert options(spark, "Q [Open-ended]")[0] == "Open-ended"
    assert options(spark, "Feeling [sic] low")[0] is None


def table(spark, rows):
    return spark.createDataFrame(
        [("d", r, None, k, v) for r, k, v in rows],
        "dataset string, respondent_id string, q_group string, q_key string, value string",
    )


ROWS = [
    ("1", "City", "x"), ("2", "City", "x"), ("3", "City", "y"), ("4", "City", "x"),
    ("1", "Age", "30"), ("2", "Age", "40"), ("4", "Age", "n/a"),
]


def test_respondent_queries(spark):
    answers = table(spark, ROWS)
    asked = spark.createDataFrame([("d", "3", "Age"), ("d", "1", "Age")], "dataset string, respondent_id string, q_key string")
    got = {r["respondent_id"]: r["value"] for r in survey.answer_lookup(answers, asked).collect()}
    assert got == {"3": "None", "1": "30"}

    wanted = [("a", "d", "City", "x"), ("b", "d", "City", "z")]
    criteria = spark.createDataFrame(wanted, "criterion string, dataset string, q_key string, value string")
    got = {tuple(r) for r in survey.reverse_lookup(answers, criteria).collect()}
    assert got == {("a", "1"), ("a", "2"), ("a", "4"), ("b", "None")}

    anchors = spark.createDataFrame([("d", "1")], "dataset string, respondent_id string")
    related = survey.related_respondents(answers, anchors, ["City"], {"Age": F.col("Age").try_cast("int") > 35})
    assert [r["respondent_id"] for r in related.collect()] == ["2"]

    counts = {r["respondent_id"]: r["related"] for r in survey.related_counts(answers, ["City"]).collect()}
    assert counts == {"1": 2, "2": 2, "3": 0, "4": 2}

    rules = [("City", F.col("value") == "x"), ("Age", F.col("value").try_cast("int") > 35)]
    ids = lambda df: sorted(r["respondent_id"] for r in df.collect())
    assert ids(survey.rule_matches(answers, rules)) == ["2"]
    assert ids(survey.rule_matches(answers, rules, at_least=1)) == ["1", "2", "4"]
    assert survey.respondent_count(answers, F.col("value") == "x").first()["respondents"] == 3


def test_related_counts_match_brute_force(spark):
    rows = [(str(i), k, str(i * p % m)) for i in range(60) for k, p, m in (("a", 7, 5), ("b", 3, 4))]
    counts = survey.related_counts(table(spark, rows), ["a", "b"]).collect()
    by_id = {r: (a, b) for r, a, b in [(str(i), str(i * 7 % 5), str(i * 3 % 4)) for i in range(60)]}
    for c in counts:
        same = sum(v == by_id[c["respondent_id"]] for v in by_id.values()) - 1
        assert c["related"] == same


def test_values(spark):
    answers = table(spark, [("1", "k", "['C', 'B']"), ("2", "k", "A"), ("3", "k", "Dev, front;Ops")])
    got = {(r["respondent_id"], r["item"]) for r in survey.explode_choices(answers).collect()}
    assert got == {("1", "C"), ("1", "B"), ("2", "A"), ("3", "Dev, front"), ("3", "Ops")}

    twice = table(spark, [("1", "k", "long text"), ("1", "k", "long"), ("1", "j", "")])
    assert {(r["q_key"], r["value"]) for r in survey.one_per_respondent(twice).collect()} == {("k", "long text"), ("j", "")}
    wide = survey.wide_view(twice, ["k", "j", "none"]).first()
    assert (wide["k"], wide["j"], wide["none"]) == ("long text", "", None)

    typed = table(spark, [("1", "k", "2021-03-05"), ("2", "k", "Less than 1 year"), ("3", "k", "1e2"), ("4", "k", "")])
    got = {r["respondent_id"]: r["v"] for r in typed.select("respondent_id", survey.typed_value(F.col("value")).alias("v")).collect()}
    assert str(got["1"]["date"]) == "2021-03-05" and got["1"]["number"] is None
    assert (got["2"]["number"], got["3"]["number"], got["4"]["text"]) == (None, 100.0, None)


def test_codes_find_their_option(spark):
    label = "Q [MCQ: 1. Male 2. Female]"
    questions = with_question_type(
        spark.createDataFrame([("d", "G", label)], "dataset string, q_key string, label string")
    )
    answers = table(spark, [("1", "G", "1.0"), ("2", "G", "2"), ("3", "G", "9")])
    got = survey.decode_options(answers, survey.option_labels(questions))
    assert {(r["respondent_id"], r["label"]) for r in got.collect()} == {("1", "Male"), ("2", "Female"), ("3", None)}


def test_replies(spark):
    rows = [
        ("anthropic.claude-x", '{"content": []}', None),
        ("a.Qwen", '{"choices": [{"message": {}}]}', ""),
        ("a.Qwen", '{"output": " o "}', "o"),
        ("deepseek-r1", '{"choices": [], "output": "t"}', "t"),
        ("deepseek", '{"generation": "g", "output": "t"}', "g"),
        ("meta.llama", "{}", ""),
        ("mistral", "{}", ""),
        ("mistral", '{"outputs": []}', None),
        ("amazon.titan", '{"results": [{"outputText": "\\n x"}]}', "x"),
        ("other", ' {"a": 1} ', '{"a": 1}'),
    ]
    df = spark.createDataFrame(rows, "model string, reply string, wanted string")
    got = df.withColumn("got", exchange.reply_text(F.col("model"), F.col("reply")))
    assert [r for r in got.collect() if r["got"] != r["wanted"]] == []


def test_family_precedence(spark):
    df = spark.createDataFrame([("mistral-qwen",), ("DeepSeek-R1",), ("Mistral",)], "m string")
    got = [r[0] for r in df.select(exchange.family(F.col("m"))).collect()]
    assert got == ["qwen", "deepseek_r1", "generic"]


def test_envelope_of_a_failed_call(spark):
    df = spark.createDataFrame([("x", None, 1.5), (None, None, 0.5), ("x", "HTTP 500", 2.0)], "t string, e string, s double")
    got = [tuple(r[0]) for r in df.select(exchange.envelope(F.col("t"), F.col("e"), F.col("s"))).collect()]
    assert got == [
        ("x", True, None, 1.5), ("", False, "reply lacks its text", 0.5), ("", False, "HTTP 500", 2.0),
    ]


def test_group_nodes_find_all_their_owners(spark):
    text = """:Respondent1 pred:Age "3" .
:Respondent2 pred:Age "4" .
:Respondent1_G pred:Mood "x" .
:Respondent1 pred:hasGroupResponse :Respondent1_G .
:Respondent2 pred:hasGroupResponse :Respondent1_G .
:Respondent2_H pred:Mood "y" .
"""
    docs = document(spark, text, "ttl")
    assert {tuple(r) for r in turtle.answers(docs).select(*COLUMNS).collect()} == {
        ("1", None, "Age", "3"), ("2", None, "Age", "4"), ("1", "G", "Mood", "x"), ("2", "G", "Mood", "x"),
    }
    assert [r["node"] for r in turtle.unlinked(docs).collect()] == ["Respondent2_H"]


def test_separators_are_plain_and_items_stripped(spark):
    answers = table(spark, [("1", "k", "a| b"), ("2", "k", ""), ("3", "k", "a;|b")])
    got = [(r["respondent_id"], r["item"]) for r in survey.explode_choices(answers, "|").collect()]
    assert sorted(got) == [("1", "a"), ("1", "b"), ("3", "a;"), ("3", "b")]


def cases(spark, rows):
    kinds = "dataset string, task string, case_id string, format string, respondent_id string, q_key string, value string"
    return spark.createDataFrame([("d", "t", *r) for r in rows], kinds)


def test_queries_in_one_case(spark):
    answers = cases(spark, [
        ("case_1", "md", "1", "City", "x"), ("case_1", "md", "2", "City", "x"), ("case_1", "ttl", "1", "City", "x"),
        ("case_2", "md", "1", "City", "y"), ("case_2", "md", "3", "City", "x"), ("case_2", "md", "3", "Age", "5"),
    ])
    md = survey.of_cases(answers, "md")
    asked = spark.createDataFrame([("d", "t", "case_2", "1", "City")], "dataset string, task string, case_id string, respondent_id string, q_key string")
    assert [r["value"] for r in survey.answer_lookup(md, asked, survey.CASE).collect()] == ["y"]
    criteria = spark.createDataFrame(
        [("a", "d", "t", "case_1", "City", "x"), ("b", "d", "t", "case_2", "City", "z")],
        "criterion string, dataset string, task string, case_id string, q_key string, value string",
    )
    found = survey.reverse_lookup(md, criteria, survey.CASE)
    assert {tuple(r) for r in survey.answer_text(found, ["criterion"]).collect()} == {("a", "1, 2"), ("b", "None")}
    concepts = spark.createDataFrame([("d", "c", "City", "x")] * 2, "dataset string, concept string, q_key string, value string")
    got = {(r["case_id"], r["n"]) for r in survey.concept_count(answers, concepts, survey.CASE).collect()}
    assert got == {("case_1", 2), ("case_2", 1)}
    anchors = asked.select("dataset", "task", "case_id", F.lit("3").alias("respondent_id"))
    assert survey.related_respondents(md, anchors, ["City"], per=survey.CASE).count() == 0
    rules = survey.rule_matches(md, [("City", F.col("value") == "x")], per=survey.CASE)
    assert {(r["case_id"], r["respondent_id"]) for r in rules.collect()} == {("case_1", "1"), ("case_1", "2"), ("case_2", "3")}


def test_texts_of_one_row_group_are_dealt_over_all_cores(spark, tmp_path):
    rows = [(k, f"n{k}", k % 25, float(k), "BUILDING") for k in range(400)] + [(7, "n7", 7, 7.0, "BUILDING"), (None,) * 5]
    kinds = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    texts = plans.survey_texts(spark, str(tmp_path), plans.MARKDOWN_FORM, "md")
    sizes = [n for n in texts.rdd.glom().map(len).collect() if n]
    assert sum(sizes) == len(rows) and len(sizes) >= spark.sparkContext.defaultParallelism
    assert max(sizes) < len(rows) / 2
    assert markdown.answers(texts).filter("respondent_id = '7'").count() == 12
