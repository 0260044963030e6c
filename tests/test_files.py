"""Readers and writers on small files."""

import csv
import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from pollwright.constants import PROMPT_COLUMNS, RESULT_COLUMNS
from pollwright.operators import evaluate, filters, report, sinks
from pollwright.sources import documents, qa_items, results, tables


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def write_csv(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def row(case_id, **values):
    base = dict.fromkeys(PROMPT_COLUMNS, "") | {"case_id": case_id, "task": "answer_lookup"}
    return [(base | values)[c] for c in PROMPT_COLUMNS]


def test_documents(spark, tmp_path):
    write(tmp_path / "d" / "t" / "md" / "case_1.md", "# a\r\nb\n")
    write(tmp_path / "d" / "t" / "ttl" / "case_1.ttl", ":a b .")
    write(tmp_path / "d" / "t" / "ttl" / "case_2.md", "wrong ending")
    got = {tuple(r) for r in documents.read_documents(spark, str(tmp_path)).collect()}
    assert got == {("d", "t", "md", "case_1", "# a\nb\n"), ("d", "t", "ttl", "case_1", ":a b .")}


def test_skip_list(spark, tmp_path):
    write(tmp_path / "m.csv", 'note,task,dataset,case_id\n"a\nb",t,d,case_2\n,t,d,case_2\n')
    assert [tuple(r) for r in documents.read_skip_list(spark, str(tmp_path / "m.csv")).collect()] == [("d", "t", "case_2")]


ITEMS = [
    {"zeta": "z", "case_id": "case_1", "question": "q?", "expected_answer": ["a", "it's", 'x"y', 3, None, True], "prompt": "p [ZETA]"},
    {"case_id": "case_2", "n": 4, "f": 2.5, "alpha": False, "none": None, "deep": {"b": [1], "a": 2}},
]


def test_question_items(spark, tmp_path):
    write(tmp_path / "d" / "d_my_task_qa_pairs.json", json.dumps(ITEMS, indent=1))
    rows = qa_items.read_items(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r["dataset"], r["task"], r["pos"], r["case_id"]) for r in rows] == [
        ("d", "my_task", 0, "case_1"),
        ("d", "my_task", 1, "case_2"),
    ]
    assert [f["key"] for f in rows[0]["fields"]] == list(ITEMS[0])
    assert rows[0]["expected_answer"] == str(ITEMS[0]["expected_answer"])
    assert [f["is_text"] for f in rows[0]["fields"]] == [True, True, True, False, True]
    second = {f["key"]: f["value"] for f in rows[1]["fields"]}
    assert [second[k] for k in ("n", "f", "alpha", "none")] == ["4", "2.5", "False", "None"]
    assert json.loads(second["deep"]) == ITEMS[1]["deep"]
    assert rows[1]["question"] is None


def test_question_items_in_lines(spark, tmp_path):
    write(tmp_path / "d" / "d_t_qa_pairs.json", "\n".join(map(json.dumps, ITEMS)) + "\n")
    rows = qa_items.read_items(spark, str(tmp_path), layout="lines").orderBy("pos").collect()
    assert [r["case_id"] for r in rows] == ["case_1", "case_2"]


def test_catalogue(spark, tmp_path):
    write(tmp_path / "d-1" / "d-1_answer_lookup_qa_pairs.json", "[]")
    write(tmp_path / "e" / "e_respondent_count_qa_pairs.json", "[]")
    write(tmp_path / "e" / "other.json", "[]")
    got = {tuple(r) for r in documents.catalogue(spark, str(tmp_path)).collect()}
    assert got == {("d-1", "answer_lookup"), ("e", "respondent_count")}


HEADER = ",".join(RESULT_COLUMNS)
BROKEN = HEADER + '''
case_1,answer_lookup,"Who, now?",{"a": [1, 2], "b": "x,y"},"yes ""sir""",prompt [x, y] end, reply ,True
case_2,respondent_count,q,
more "quoted, comma" text,[1, 2],p,,False
case_3x,nonsense,q,d,e,p,r,True
case_4,answer_lookup,only,two
case_5,answer_lookup,"closed too often }" },a,b,c,d
'''


def tree(tmp_path):
    base = tmp_path / "model"
    write_csv(
        base / "d" / "answer_lookup" / "answer_lookup_md_converted_prompts.csv",
        PROMPT_COLUMNS,
        [
            row("case_1", question='say "hi", \nnow', expected_answer="B", Response=" It is B. ", Correct="False"),
            row(" case_2 ", expected_answer="B", Response="", skip="FALSE"),
            row("case_3", expected_answer="B", Response="B", skip=" true "),
            row("note", expected_answer="B", Response="B"),
        ],
    )
    # The scorer's own output has no skip column.
    write_csv(
        base / "d" / "answer_lookup" / "answer_lookup_ttl_converted_prompts.csv",
        RESULT_COLUMNS,
        [row("case_1", expected_answer="x", Response="y")[:-1]],
    )
    write(base / "e" / "answer_lookup" / "answer_lookup_json_converted_prompts.csv", "# broken\n" + BROKEN)
    write(base / "e" / "answer_lookup" / "answer_lookup_xml_converted_prompts.csv", BROKEN.replace("case_id", "case_id\"", 1))
    write(base / "e" / "answer_lookup" / "answer_lookup_pdf_converted_prompts.csv", BROKEN)
    write(base / "e" / "top_md_converted_prompts.csv", BROKEN)
    return str(base)


def test_result_scan(spark, tmp_path):
    got = results.read_results(spark, tree(tmp_path)).filter("dataset = 'd'")
    rows = {(r["format"], r["case_id"]): r for r in got.collect()}
    assert sorted(rows) == [("md", " case_2 "), ("md", "case_1"), ("md", "case_3"), ("ttl", "case_1")]
    first = rows["md", "case_1"]
    assert (first["question"], first["Response"], first["skip"]) == ('say "hi", \nnow', " It is B. ", "")
    cells = report.accuracy(evaluate.score(got)).collect()
    assert {(c["format"], c["correct"], c["total"]) for c in cells} == {("md", 1, 2), ("ttl", 0, 1)}


def test_record_recovery(spark):
    files = spark.createDataFrame([(1, BROKEN), (2, "# no header\n" + BROKEN), (3, HEADER)], "file int, value string")
    rows = {r["case_id"]: r for r in results.recovered(files).collect()}
    assert sorted(rows) == ["case_1", "case_2"]
    one, two = rows["case_1"], rows["case_2"]
    assert [one[c] for c in RESULT_COLUMNS[2:]] == [
        "Who, now?", '{"a": [1, 2], "b": "x,y"}', 'yes "sir"', "prompt [x, y] end", "reply", "True",
    ]
    assert [two[c] for c in RESULT_COLUMNS[2:]] == [
        "q", 'more "quoted, comma" text', "[1, 2]", "p", "", "False",
    ]
    problems = results.parsed_records(files).filter("problem is not null")
    assert {(r["case_id"], r["problem"]) for r in problems.collect()} == {
        ("case_3x", "no known task"),
        ("case_4", "fewer than three fields"),
        ("case_5", "fewer than three fields"),
    }


def split_outside(text):
    """Fields between commas outside quotes, braces and brackets, character by character."""
    parts, start, quoted, depth = [], 0, False, {"{}": 0, "[]": 0}
    for at, char in enumerate(text):
        if char == '"':
            quoted ^= not text[:at].endswith("\\")
        elif not quoted and char == "," and not any(depth.values()):
            parts.append(text[start:at].strip())
            start = at + 1
        elif not quoted:
            for pair in depth:
                depth[pair] += (char == pair[0]) - (char == pair[1])
    last = text[start:].strip()
    return [*parts, last] if last else parts


def test_field_splitting(spark):
    dice = random.Random(1)
    texts = ['a, "b,c" ,{d,[e,f]},g', r'a "\",", b', "a},b,c", "a,,b,", "", ",", " ", r'\\",x', "[" * 2000 + "," + "]" * 2000 + ",e"]
    texts += ["".join(dice.choice('ab ,,""\\{}[]\n') for _ in range(dice.randrange(40))) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    found = {r["text"]: r["fields"] for r in results.with_outer_fields(rows, F.col("text"), "fields").collect()}
    assert found == {None: None} | {t: split_outside(t) for t in texts}


def test_recovery_runs_without_python(spark):
    files = spark.createDataFrame([(1, BROKEN)], "file int, value string")
    plan = results.recovered(files)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_broken_files_are_found_and_recovered(spark, tmp_path):
    base = tmp_path / "model"
    # Every standard row's case id is bad, so the text path takes over.
    text = HEADER.replace("case_id", "case_id ", 1) + "\n\"" + "\ncase_9,answer_lookup,q,d,e,p,r,True\n"
    write(base / "d" / "t" / "t_md_converted_prompts.csv", text)
    write_csv(base / "d" / "t" / "t_ttl_converted_prompts.csv", PROMPT_COLUMNS, [row("case_1")])
    rows = results.read_results(spark, str(base)).collect()
    assert {(r["format"], r["case_id"], r["Response"]) for r in rows} == {
        ("md", "case_9", "r"),
        ("ttl", "case_1", ""),
    }


def test_models(spark, tmp_path):
    for model in ("b-model", "a.model"):
        write_csv(tmp_path / model / "d" / "t" / "x.csv", PROMPT_COLUMNS, [])
    assert [r[0] for r in results.available_models(spark, str(tmp_path)).collect()] == ["a.model", "b-model"]


def test_written_csv_reads_back(spark, tmp_path):
    values = ['say "hi", \nnow', "  padded ", "", "ends with \\", "é —"]
    rows = spark.createDataFrame(
        [("d", "md", *row(f"case_{i}", question=v, Response=v)) for i, v in enumerate(values)],
        ["dataset", "format", *PROMPT_COLUMNS],
    )
    sinks.write_prompts(rows, str(tmp_path / "out"), source="csv")
    back = tables.read_table(spark, str(tmp_path / "out"), "csv")
    got = {r["case_id"]: (r["question"], r["Response"]) for r in back.collect()}
    assert got == {f"case_{i}": (v, v) for i, v in enumerate(values)}


def test_tables_keep_partitions_and_skip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("v", "d", "md", *row("case_1", skip="TRUE")), ("w", "d", "ttl", *row("case_1"))],
        ["variant", "dataset", "format", *PROMPT_COLUMNS],
    )
    sinks.write_prompts(rows, str(tmp_path / "p"), "variant")
    back = spark.read.parquet(str(tmp_path / "p"))
    assert {(r["variant"], r["format"], r["dir_task"], r["skip"]) for r in back.collect()} == {
        ("v", "md", "answer_lookup", "TRUE"),
        ("w", "ttl", "answer_lookup", ""),
    }
    pruned = filters.in_slice(back, variant="v")
    assert "PartitionFilters: [isnotnull(variant" in pruned._jdf.queryExecution().executedPlan().toString()
    scored = evaluate.update_flags(evaluate.score(back))
    sinks.write_results(scored.drop("is_correct", "changed"), str(tmp_path / "r"))
    assert "skip" in spark.read.parquet(str(tmp_path / "r")).columns


def test_report_file(spark, tmp_path):
    cells = spark.createDataFrame(
        [("d", "answer_lookup", "md", 1, 2)],
        "dataset string, dir_task string, format string, correct long, total long",
    )
    sinks.write_report(report.count_table(cells, ["answer_lookup"]), str(tmp_path / "c"))
    (part,) = (tmp_path / "c").glob("part-*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == "Format,answer_lookup"
    assert lines[1:4] == ["html,N/A", "json,N/A", "md,1/2"]


def test_discover_reads_the_path_only_below_the_base(spark):
    paths = [
        "file:///data/m/d/t/t_md_converted_prompts.csv",
        "file:///data/m/d/t/deeper/t_md_converted_prompts.csv",
        "file:///data/m/d/t_md_converted_prompts.csv",
        "file:///data/m/d/t/t_md_html_converted_prompts.csv",
    ]
    files = spark.createDataFrame([(p,) for p in paths], "_path string")
    got = [(r["_path"][-28:], r["format"]) for r in results.discover(files, "/data/m").collect()]
    assert [f for _, f in got] == ["md", "html"]


FORMS = [
    "task,case_id,skip,Response\nanswer_lookup,case_1,TRUE,x\n",
    'case_id,task,model,question,Response,Correct\r\ncase_1,answer_lookup,m,"a\nb",x,\r\n',
    "case_id,response_time,task,Response\ncase_1,1.5,answer_lookup,x\nnote,2,t,y\n",
    "case_id,task,question,questionnaire,expected_answer,prompt,response_time,Response,skip\n"
    "case_1,answer_lookup,q,d,e,p,1.5,x,TRUE\n",
]


def test_columns_are_found_by_header(spark, tmp_path):
    for i, text in enumerate(FORMS):
        write(tmp_path / "my data [1]" / "t+u é" / f"t{i}_md_converted_prompts.csv", text)
    write(tmp_path / "my data [1]" / "t+u é" / "b_ttl_converted_prompts.csv", "case_id \n\"\ncase_1,answer_lookup,q,d,e,p,x,True\n")
    tracker, group = spark.sparkContext.statusTracker(), "lazy"
    spark.sparkContext.setJobGroup(group, "reading starts no job")
    rows = results.read_results(spark, str(tmp_path))
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = [(r["dataset"], r["dir_task"], r["format"], r["case_id"], r["Response"]) for r in rows.collect()]
    assert sorted(got) == [("my data [1]", "t+u é", "md", "case_1", "x")] * 4 + [("my data [1]", "t+u é", "ttl", "case_1", "x")]
    assert sorted(r["skip"] for r in rows.collect()) == ["", "", "", "TRUE", "TRUE"]


def test_paths_agree(spark, tmp_path):
    write(tmp_path / "my data" / "my data_a+b_qa_pairs.json", json.dumps(ITEMS[:1]))
    write(tmp_path / "c" / "my data" / "a+b" / "md" / "case_1.md", "é\r\rx")
    write(tmp_path / "skip.csv", "dataset,task,case_id\nmy data,a+b,case_1\n")
    docs = documents.read_documents(spark, str(tmp_path / "c"))
    items = qa_items.read_items(spark, str(tmp_path))
    from pollwright.operators import prompts

    rows = prompts.with_skip_flag(prompts.items_with_documents(items, docs), documents.read_skip_list(spark, str(tmp_path / "skip.csv")))
    assert [(r["dataset"], r["task"], r["content"], r["skip"]) for r in rows.collect()] == [("my data", "a+b", "é\n\nx", "TRUE")]
    assert [tuple(r) for r in documents.catalogue(spark, str(tmp_path)).collect()] == [("my data", "a+b")]


def test_numbers_of_items_are_printed_like_python(spark, tmp_path):
    values = [3.0, 1e3, [1.0, 2.5], 7, 1e22, 1.5e-7, 12345678901234567890, 1e7, 0.001, -2.0]
    texts = ["3.0", "1e3", "[1.0, 2.50]", "7", "1e22", "1.5e-7", "12345678901234567890", "10000000.0", "0.001", "-2.0"]
    objects = spark.createDataFrame(
        [("d", "t", i, f'{{"case_id":"case_1","expected_answer":{x}}}') for i, x in enumerate(texts)],
        "dataset string, task string, pos long, value string",
    )
    rows = qa_items.items_from_objects(objects).orderBy("pos").collect()
    assert [r["expected_answer"] for r in rows] == [str(v) for v in values]


def test_tables_close_the_loop(spark, tmp_path):
    rows = spark.createDataFrame(
        [("07", "md", *row("case_1", expected_answer="B", Response="B")), ("07", "ttl", *row("case_2", expected_answer="B"))],
        ["dataset", "format", *PROMPT_COLUMNS],
    )
    for source in ("parquet", "csv"):
        sinks.write_prompts(rows, str(tmp_path / source / "p"), source=source)
        read = tables.read_table(spark, str(tmp_path / source / "p"), source)
        scored = evaluate.score(filters.valid_cases(read))
        sinks.write_results(evaluate.update_flags(scored), str(tmp_path / source / "r"))
        cells = report.accuracy(evaluate.score(tables.read_table(spark, str(tmp_path / source / "r"))))
        got = {(c["dataset"], c["dir_task"], c["format"], c["correct"], c["total"]) for c in cells.collect()}
        assert got == {("07", "answer_lookup", "md", 1, 1), ("07", "answer_lookup", "ttl", 0, 1)}
    docs = spark.createDataFrame([("d", "t", "md", "case_1", "x\n")], "dataset string, task string, format string, case_id string, content string")
    sinks.write_documents(docs, str(tmp_path / "docs"))
    assert tables.read_table(spark, str(tmp_path / "docs")).select(docs.columns).collect() == docs.collect()


def tree_of(folder):
    return {str(f.relative_to(folder)): f.read_bytes() for f in folder.rglob("*") if f.is_file() and f.suffix in (".parquet", ".csv")}


def scored_table(spark, path, source):
    rows = [
        (dataset, fmt, *row(f"case_{i}", expected_answer="B", Response="B" if i % 2 else "C", Correct=str(bool(i % 2)), skip=" true " if i == 3 else ""))
        for dataset in ("d", "e", "f f=1") for fmt in ("md", "ttl") for i in range(5)
    ]
    df = spark.createDataFrame(rows, ["dataset", "format", *PROMPT_COLUMNS])
    sinks.write_results(df.withColumn("dir_task", df["task"]), path, source=source)


def edit(rows, where):
    """Rows with wrong flags in some places, told as changed."""
    new = F.when(F.expr(where), "edited").otherwise(F.col("Correct"))
    return rows.withColumn("changed", ~new.eqNullSafe(F.col("Correct"))).withColumn("Correct", new)


def rescored(rows):
    return evaluate.update_flags(evaluate.score(rows))


@pytest.mark.parametrize("source", ["parquet", "csv"])
def test_only_changed_folders_are_written_anew(spark, tmp_path, source):
    path = tmp_path / "results"
    scored_table(spark, str(path), source)
    first = sorted(map(repr, tables.read_table(spark, str(path), source).collect()))
    before = tree_of(path)
    assert not sinks.rewrite_changed(spark, str(path), rescored, source=source) and tree_of(path) == before
    where = "dataset = 'f f=1' and format = 'ttl' and case_id in ('case_1', 'case_3') or dataset = 'd' and format = 'md' and case_id = 'case_2'"
    assert sinks.rewrite_changed(spark, str(path), lambda rows: edit(rows, where), source=source)
    edited = tree_of(path)
    kept = {name for name in before if not name.startswith(("dataset=f f%3D1/dir_task=answer_lookup/format=ttl", "dataset=d/dir_task=answer_lookup/format=md"))}
    assert kept == set(before) & set(edited) and all(before[n] == edited[n] for n in kept) and len(kept) == 4
    assert sinks.rewrite_changed(spark, str(path), rescored, source=source)
    again = tree_of(path)
    assert all(again[n] == before[n] for n in kept) and set(again) & set(edited) == kept
    rows = sorted(map(repr, tables.read_table(spark, str(path), source).collect()))
    # a skipped row keeps what was written into it
    assert rows == sorted(r.replace("Correct='True'", "Correct='edited'") if "f f=1" in r and "ttl" in r and "case_3" in r else r for r in first)
    assert not sinks.rewrite_changed(spark, str(path), rescored, source=source) and tree_of(path) == again
    assert not (tmp_path / "results__changed").exists()


def test_a_lost_rewrite_is_finished(spark, tmp_path, monkeypatch):
    path = tmp_path / "results"
    scored_table(spark, str(path), "parquet")
    where = "dataset = 'd'"
    finish = sinks.finish_rewrite
    lost = iter([False])
    monkeypatch.setattr(sinks, "finish_rewrite", lambda *a: next(lost, None))
    sinks.rewrite_changed(spark, str(path), lambda rows: edit(rows, where))
    monkeypatch.setattr(sinks, "finish_rewrite", finish)
    shutil.rmtree(path / "dataset=d" / "dir_task=answer_lookup" / "format=md")  # as if lost while folders were replaced
    assert not sinks.rewrite_changed(spark, str(path), lambda rows: rows.withColumn("changed", F.lit(False)))
    rows = tables.read_table(spark, str(path)).groupBy("dataset", "Correct").count().collect()
    assert {(r["dataset"], r["Correct"]): r["count"] for r in rows} == {
        ("d", "edited"): 10, ("e", "True"): 4, ("e", "False"): 6, ("f f=1", "True"): 4, ("f f=1", "False"): 6,
    }


def test_the_last_file_of_a_group_counts(spark, tmp_path):
    folder = tmp_path / "d" / "t"
    write_csv(folder / "a_md_converted_prompts.csv", PROMPT_COLUMNS, [row(f"case_{i}", expected_answer="B", Response="B") for i in range(3)])
    write_csv(folder / "b_md_converted_prompts.csv", PROMPT_COLUMNS, [row("case_1", expected_answer="B", Response="C")])
    write_csv(folder / "c_md_converted_prompts.csv", PROMPT_COLUMNS, [])
    scored = evaluate.score(results.read_results(spark, str(tmp_path), with_file=True))
    assert [(r["correct"], r["total"]) for r in report.accuracy(scored).collect()] == [(3, 4)]
    assert [(r["correct"], r["total"]) for r in report.accuracy(scored, file="file").collect()] == [(0, 1)]
