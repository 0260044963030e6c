"""Large result files, read in ranges: the same rows as files read whole."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from pollwright.constants import PROMPT_COLUMNS, RESULT_COLUMNS
from pollwright.sources import ranges, results
from tests.test_files import BROKEN, HEADER, row, write


@pytest.fixture
def small_ranges(spark):
    """Files are cut into ranges of so many bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    old = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
        spark.conf.set(names[2], "1")

    yield use
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def as_csv(rows, quoting=csv.QUOTE_MINIMAL, end="\r\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, quoting=quoting, lineterminator=end)
    writer.writerow(PROMPT_COLUMNS)
    writer.writerows(rows)
    return out.getvalue()


def random_file(dice, rows, end):
    texts = ['say "hi", now', "two\nlines", "dos\r\nline", "", "a,b", '"', '""\n"', "é ü\n\n\n", "x" * 90, "lone\rreturn", "tail\n"]
    cell = lambda: "".join(dice.choice(texts) for _ in range(dice.randrange(4)))
    made = [row(f"case_{i}" if dice.random() < 0.9 else "note", question=cell(), questionnaire=cell(), prompt=cell(), Response=cell()) for i in range(rows)]
    return as_csv(made, dice.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), end)


ODD = {
    "unclosed": as_csv([row("case_1")]) + 'case_2,t,"never closed,\ncase_3,t,q\n',
    "unclosed at the very end": as_csv([row("case_1")]) + 'case_2,t,q,d,e,"open',
    "after a quote": as_csv([row("case_1")]) + 'case_2,t,"q" more "x",d "e" f,"g""h"i,p,r,True,\n' * 30,
    "short row": "task,case_id\nt,case_1\nonly\n" + "t,case_2\n" * 40,
    "no case id": "a,b\n" + "1,2\n" * 60,
    "empty": "",
    "header only": HEADER + "\n",
    "header twice": "case_id,task,case_id\n" + "note,t,case_1\ncase_2,t,note\n" * 20,
    "lone returns": "case_id,task\rcase_1,a\rcase_2,b\ncase_3,c\rcase_4,d\n" * 9,
    "blank lines": "case_id,task\n\n\n" + "case_1,a\n\n" * 40,
    "long field": as_csv([row("case_1", question="y" * 140_000)]),
    "broken": BROKEN * 6,
    "broken header": BROKEN.replace("case_id", 'case_id"', 1) * 6,
    "broken without end": HEADER.replace("case_id", 'case_id"', 1) + "\n" + ("case_1,answer_lookup,q,d,\r\nmore,e,p,r,True\r\n" * 30).rstrip(),
    "starts with text": "# note\n" + BROKEN,
}


def everything(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize(("size", "rows", "longest"), [(149, 10, 3000), (8_000, 300, 200_000)])
def test_ranges_give_the_rows_of_whole_files(spark, tmp_path, small_ranges, size, rows, longest):
    dice = random.Random(size)
    files = {name: text for name, text in ODD.items() if len(text) <= longest}
    for i in range(3):
        files[f"random {i}"] = random_file(dice, rows, dice.choice(["\n", "\r\n"]))
    for i, (name, text) in enumerate(files.items()):
        write(tmp_path / "base" / f"d+{i} {name}" / "t" / "t_md_converted_prompts.csv", text)
    write(tmp_path / "base" / "other" / "t" / "t_pdf_converted_prompts.csv", BROKEN)
    base = str(tmp_path / "base")
    whole, problems = everything(results.read_results(spark, base)), everything(results.quarantined(spark, base))
    assert len(whole) > 200 and problems
    small_ranges(size)
    texts = ranges.lines(spark, base, F.lit(True))
    assert texts.select("_path", "_range").distinct().count() > (20 if size > 1000 else 60)
    assert everything(results.read_results(spark, base, whole_bytes=0)) == whole
    assert everything(results.quarantined(spark, base, whole_bytes=0)) == problems


def test_a_line_from_either_start():
    for text, from_start in [
        ("a,b", False), ('a,"b', True), ('a"b', False), ('"a""', True), ('x",y', False), ('x","y', True),
        ('"a"b"c', False), ('a,"b""c"', False), ('""', False), ('"', True), ('a\r"b', True), ("", False),
    ]:
        assert ranges.ends_quoted(text, False) is from_start, text
        # a quoted field that goes on: what csv makes of it with an opening quote before
        rows = list(ranges.records('"' + text + "\nnext"))
        assert ranges.ends_quoted(text, True) is (not (len(rows) > 1 and rows[-1] == ["next"])), text
    assert ranges.ends_quoted('"a,' * 200_000, False) in (True, False)  # long lines need no deep recursion


def test_recovered_records_need_no_python(spark, tmp_path):
    write(tmp_path / "d" / "t" / "t_md_converted_prompts.csv", BROKEN)
    found = ranges.record_lines(ranges.lines(spark, str(tmp_path), F.lit(True)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and found.count() == 5
    assert RESULT_COLUMNS[0] == "case_id"
