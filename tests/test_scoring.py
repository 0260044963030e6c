import ast
import json
import random
import re
import warnings

import pytest
from pyspark.sql import functions as F

from pollwright.functions import answers, text
from pollwright.operators import evaluate

LOOKUP, REVERSE, CONCEPT = "answer_lookup", "answer_reverse_lookup", "conceptual_aggregation"


def one(spark, column_of, *values):
    """Each value through a column function, by way of a real table."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", column_of(F.col("v")).alias("r"))
    return [r["r"] for r in df.orderBy("i").collect()]


def test_answer_section(spark):
    got = one(
        spark,
        answers.answer_section,
        "### analysis ### x ### ANSWER ### 42 ### END ###",
        "### ANSWER ### 42",
        "###answer###\n a\nb \n###End### tail ### ANSWER ### no ### END ###",
        "### ANSWER ###### END ###",
        "plain",
    )
    assert got == ["42", "### ANSWER ### 42", "a\nb", "", "plain"]


def test_normalise(spark):
    got = one(
        spark,
        text.normalise,
        ' "\'a  b\'" ',
        "'\"a\"'",
        "a  b\x1cc\n",
        '""',
        "\x1d",
        " 'x\" ",
    )
    assert got == ["a b", '"a"', "a b c", "", "", "x"]


def test_is_blank(spark):
    assert one(spark, text.is_blank, None, "", " \n　\x1f", "x") == [True, True, True, False]


PARSED = {
    "['1', '2']": (True, ["1", "2"]),
    "\"['1', '2']\"": (True, ["1", "2"]),
    "'[1, 2]'": (True, ["1", "2"]),
    '["A"]': (True, ["A"]),
    "[1, -2.5, None]": (True, ["1", "-2.5", "None"]),
    "[null, true]": (True, ["None", "True"]),
    "['null, x', null]": (True, ["null, x", "None"]),
    "[' a ', \"b'c\"]": (True, ["a", "b'c"]),
    "['it\\'s', 'b,c']": (True, ["it's", "b,c"]),
    "['a',]": (True, ["a"]),
    "['']": (True, [""]),
    "[ ]": (True, []),
    "[]": (True, []),
    "[a, b]": (True, ["[a", "b]"]),
    "[a]": (False, ["[a]"]),
    "a,": (False, ["a,"]),
    "a, ,b": (False, ["a, ,b"]),
    ' 3 , "x", \'y\' ': (True, ["3", "x", "y"]),
    "\"a, 'b'\"": (True, ["a", "b"]),
    "Developer, front-end": (True, ["Developer", "front-end"]),
    "'single'": (False, ["single"]),
    '"': (False, [""]),
    "": (False, [""]),
    "007": (False, ["007"]),
    "[007]": (False, ["[007]"]),
}


def test_expected_items(spark):
    df = spark.createDataFrame([(k,) for k in PARSED], "e string")
    rows = answers.with_items(df, F.col("e"), "is_list", "items").collect()
    assert {r["e"]: (r["is_list"], r["items"]) for r in rows} == PARSED


def test_long_lists_do_not_exhaust_the_stack(spark):
    items = [f"'{i}'" for i in range(60_000)]
    df = spark.createDataFrame([("[" + ", ".join(items) + "]",)], "e string")
    row = answers.with_items(df, F.col("e"), "l", "x").select("l", F.size("x")).first()
    assert tuple(row) == (True, 60_000)


def test_identifiers(spark):
    got = one(
        spark,
        answers.identifiers,
        "Respondent107",
        "A1",
        "HOSP_1",
        "2021-03-05 and -4.5",
        "Case_7 case_7 B2 x_9y 12",
        "é25 ñ_3 25é",
    )
    assert got == [
        ["107"],
        ["A1", "1"],
        ["HOSP_1"],
        ["2021", "03", "05", "4", "5"],
        ["12", "Case_7", "case_7", "B2", "2"],
        [],
    ]


def test_identifier_set_holds_the_same(spark):
    words = ["Respondent107 A1", "HOSP_1, case_2; 2021-03-05 B_7 b7", "x1y 9"]
    assert [sorted(v) for v in one(spark, answers.identifier_set, *words)] == [
        sorted(v) for v in one(spark, answers.identifiers, *words)
    ]


SCORED = [
    # task, response, expected, right
    (REVERSE, "2, 1", "['1','2']", True),
    (REVERSE, "1, 2, 3", "['1','2']", False),
    (REVERSE, "none", "None", True),
    (REVERSE, "none", "['None']", False),
    (REVERSE, "nobody", "[]", True),
    (REVERSE, "A1", "['A1']", False),
    (REVERSE, "A1", "['A1', '1']", True),
    (REVERSE, "Respondent107", "107", True),
    (REVERSE, "Respondent 107 and 108", "107", True),
    (REVERSE, "", "", False),
    (REVERSE, "x", None, False),
    ("rule_based_querying", "DOC_07", "['doc_07']", False),
    ("multi_hop_relational_inference", "3 4", "4, 3", True),
    (LOOKUP, "x", "", True),
    (LOOKUP, "x", None, True),
    (LOOKUP, "The  value is\tB.", "value IS b", True),
    (LOOKUP, "None", "none", True),
    (LOOKUP, " ", "", False),
    (LOOKUP, None, "", False),
    (CONCEPT, "about 3 of 10", "10", True),
    (CONCEPT, "about 3 of 100", "10", False),
    (CONCEPT, "10", "ten", False),
    (CONCEPT, "10", "10 or 20", True),
    ("respondent_count", "20", "10 or 20", False),
    (" Answer_Lookup ", "yes: abc", "ABC", True),
    ("no such task", "yes: abc", "ABC", True),
    (None, "yes: abc", "ABC", True),
    (REVERSE, "### ANALYSIS ### 9 ### ANSWER ### 1 ### END ###", "['1']", True),
    (REVERSE, "### ANSWER ### ### END ###", "[]", False),
]


def test_score(spark):
    rows = [(i, *r) for i, r in enumerate(SCORED)]
    df = spark.createDataFrame(
        rows, "i int, task string, Response string, expected_answer string, wanted boolean"
    )
    wrong = evaluate.score(df).filter("is_correct is null or is_correct <> wanted").collect()
    assert wrong == []


@pytest.mark.parametrize("order", [["1", "2", "3"], ["3", "1", "2"]])
def test_list_order_is_irrelevant(spark, order):
    df = spark.createDataFrame([(str(order), "3 2 1")], "expected_answer string, Response string")
    assert evaluate.apply_rule(df, REVERSE).first()["is_correct"]


def test_update_flags(spark):
    rows = [("TRUE", "x", False), ("", "True", True), ("", "", False), (None, None, True)]
    df = spark.createDataFrame(rows, "skip string, Correct string, is_correct boolean")
    got = [(r["Correct"], r["changed"]) for r in evaluate.update_flags(df).collect()]
    assert got == [("x", False), ("True", False), ("False", True), ("True", True)]


@pytest.mark.parametrize(
    "expected, items",
    [
        ("[+5, 6]", ["5", "6"]),
        ("[0x10, 0b11, 0o17, 1_000]", ["16", "3", "15", "1000"]),
        ("[1.50, 1e3, -2.0, .5, 1e22]", ["1.5", "1000.0", "-2.0", "0.5", "1e+22"]),
        (r"""['café', 'a\tb', 'it\'s', "x\"y"]""", ["café", "a\tb", "it's", 'x"y']),
        (r"""['say "hi"\n', 'b\\c', '\x41']""", ['say "hi"', "b\\c", "A"]),
        ("[null, true, 'None']", ["None", "True", "None"]),
        ("[-0, 00]", ["0", "0"]),
    ],
)
def test_list_literals(spark, expected, items):
    from pollwright.functions import answers as reading

    rows = spark.createDataFrame([(expected,)], "e string")
    got = reading.with_items(rows, F.col("e"), "is_list", "items").first()
    assert (got["is_list"], got["items"]) == (True, items)


@pytest.mark.parametrize("expected, response", [('"3 ", 4', "3, 4"), ("'1 ', ' 2'", "1, 2"), ("[+5, 0x10]", "16 and 5")])
def test_items_are_stripped_after_their_quotes(spark, expected, response):
    rows = spark.createDataFrame(
        [(expected, response, REVERSE)], "expected_answer string, Response string, task string"
    )
    assert evaluate.score(rows).first()["is_correct"]


def read_expected(text):
    """An expected answer read character by character with Python's own parsers."""
    text = text.strip()
    for quote in "\"'":
        if text.startswith(quote) and text.endswith(quote):
            text = text[1:-1].strip()
            break
    if text.startswith("[") and text.endswith("]"):
        for parse in (ast.literal_eval, json.loads):
            try:
                return [str(item).strip() for item in parse(text)]
            except (ValueError, SyntaxError, TypeError):
                pass
    parts = [part.strip().strip('"').strip("'") for part in text.split(",")]
    return parts if len(parts) > 1 and all(parts) else text.strip()


def random_literal(dice, depth):
    kind = dice.random()
    if not depth or kind < 0.35:
        return dice.choice(["1", "2.5", "'a'", '"b c"', "None", "True", r"'it\'s'", "-7", "1e3", r'"say \"x\ny\""', "'é\u00a0'"])
    inner = [random_literal(dice, depth - 1) for _ in range(dice.randrange(4))]
    space, tail = dice.choice(["", " ", "\n"]), dice.choice(["", ","]) if inner else ""
    if kind < 0.6:
        return "[" + space + ("," + space).join(inner) + tail + "]"
    if kind < 0.75:
        return "(" + ",".join(inner) + tail + ")"
    if kind < 0.92:
        return "{" + ("," + space).join(f"'k{i}':{space}{v}" for i, v in enumerate(inner)) + tail + "}"
    return "{1" + tail + "}"


NESTED = [
    "[[1,2],[3]]", "[['a', \"b's\"], ('x',), ('y','z',), (1), ('w')]", "[{'k': [1, 2.50], 'l': None}, {}]", "[{1,2}, set]", "[[[[]]]]",
    "[[1,2]", "[1], [2]", "[ [1 ,2 ] , ]", '[{"a": true, "b": null}, [false]]', "[{'a': 1, 2}]", "[{[1]: 2}]", "[{(1,2): [3]}]",
    "[[1,,2]]", "[[1 2]]", "[()]", "[(),]", "[((1))]", "[(((1,)))]", "[{'a':}]", "[[x]]", "[[1]]]", "[[1.0e5, 0x1F, -3, +4, 1_000]]",
    "  \"[[1], ['b, c']]\"  ", "[[1],]", "[,]", "[[,]]", "[{1: 2, 3}]", "[{1, 2: 3}]", "[(1,]", "[{'x' 1}]", "[' [1] ', [ ' a ' ]]",
    "[({'a'},)]", "[({({},): 1})]", "[" * 60 + "]" * 60, "[[" + "1, " * 3000 + "1]]", "[[" + "'x', " * 2000,
]


def test_nested_literals(spark):
    """Nested containers print as Python prints them; what is no literal is read as before."""
    dice = random.Random(4)
    texts = list(NESTED)
    for _ in range(300):
        texts.append("[" + ",".join(random_literal(dice, 3) for _ in range(dice.randrange(1, 4))) + "]")
        at = dice.randrange(len(texts[-1]))
        if dice.random() < 0.4 and texts[-1][at - 1] != "\\":
            texts.append(texts[-1][:at] + dice.choice("[](){},:' 1") + texts[-1][at + dice.randrange(2) :])
    # of a dict's equal keys only the last counts, which is not read so
    texts = [t for t in dict.fromkeys(texts) if not re.search(r"'k1'.*'k1'|'k0'.*'k0'", t, re.DOTALL)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = answers.with_items(rows, F.col("text"), "is_list", "items").collect()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", SyntaxWarning)
        wanted = {t: read_expected(t) for t in texts}
    assert {r["text"]: r["items"] if r["is_list"] else r["items"][0] for r in found} == wanted
