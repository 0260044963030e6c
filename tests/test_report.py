from pyspark.sql import functions as F

from pollwright.operators import filters, report


def cells(spark, rows):
    return spark.createDataFrame(
        rows, "dataset string, dir_task string, format string, correct long, total long"
    )


def test_tables(spark):
    rows = cells(
        spark,
        [
            ("a", "answer_lookup", "md", 1, 3),
            ("b", "answer_lookup", "md", 1, 5),
            ("a", "respondent_count", "ttl", 0, 0),
            ("a", "respondent_count", "md", 49, 400),
        ],
    )
    counts = {r["format"]: r for r in report.count_table(rows).collect()}
    shares = {r["format"]: r for r in report.percentage_table(rows).collect()}
    assert sorted(counts) == ["html", "json", "md", "ttl", "txt", "xml"]
    assert counts["md"]["answer_lookup"] == "2/8" and shares["md"]["answer_lookup"] == "25.0%"
    assert counts["ttl"]["respondent_count"] == "N/A" == shares["ttl"]["respondent_count"]
    # 49/400 = 12.25 %: a tie goes to the even digit.
    assert shares["md"]["respondent_count"] == "12.2%"
    assert counts["xml"]["answer_lookup"] == "N/A"


def test_tables_of_many_groups_stay_out_of_the_driver(spark):
    rows = [(f"d{n}", "t", "md", n % 2, 2) for n in range(500)] + [(None, "u", "md", 1, 1)]
    got = report.count_table(cells(spark, rows), by=["dataset"], formats=("md", "xml"))
    assert "LocalTableScan" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in got._jdf.queryExecution().optimizedPlan().toString()
    found = {(r["dataset"], r["format"]): (r["t"], r["u"]) for r in got.collect()}
    assert len(found) == 1002 and found["d7", "md"] == ("1/2", "N/A") and found["d7", "xml"] == ("N/A", "N/A")
    assert found[None, "md"] == ("N/A", "1/1")


def test_skipped_rows_do_not_count(spark):
    rows = [("d", "t", "md", True, ""), ("d", "t", "md", False, " true "), ("d", "t", "md", False, None)]
    df = spark.createDataFrame(
        rows, "dataset string, dir_task string, format string, is_correct boolean, skip string"
    )
    got = report.accuracy(df).first()
    assert (got["correct"], got["total"], got["percentage"]) == (1, 2, 50.0)


def test_all_skipped_group_has_no_total(spark):
    df = spark.createDataFrame(
        [("d", "t", "md", True, "TRUE")],
        "dataset string, dir_task string, format string, is_correct boolean, skip string",
    )
    assert tuple(report.accuracy(df).first())[3:] == (0, 0, 0.0)


def test_grand_total_of_nothing(spark):
    got = report.summarise(cells(spark, [])).first()
    assert tuple(got) == (0, 0, 0.0)


def test_case_window_above_sparks_own_cut(spark):
    rows = spark.range(5000).select(
        F.lit("d").alias("dataset"), F.concat(F.lit("case_"), F.col("id") % 2500).alias("case_id"), "id"
    )
    got = filters.case_window(rows, ["dataset"], ["id"], start_case=3, max_cases=1500, salts=7)
    plain = filters.case_window(rows, ["dataset"], ["id"], start_case=3)
    wanted = plain.orderBy("case_no", "id").limit(1500)
    assert got.exceptAll(wanted).count() == 0 and got.count() == 1500


def test_rank_limit_reaches_the_map_side(spark):
    rows = spark.range(100).withColumn("case_id", F.concat(F.lit("case_"), "id"))
    limited = filters.case_window(rows.withColumn("g", F.lit(1) * F.col("id") % 2), ["g"], ["id"], max_cases=5)
    plan = limited._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_reports_show_what_was_seen(spark):
    kinds = "model string, dataset string, dir_task string, format string, correct long, total long"
    none = report.count_table(spark.createDataFrame([], kinds)).collect()
    assert [r["format"] for r in none] == ["html", "json", "md", "ttl", "txt", "xml"]
    assert all(x == "N/A" for r in report.count_table(spark.createDataFrame([], kinds), ["a"]).collect() for x in r[1:])
    cells = spark.createDataFrame([("m", "d", "zz_new", "md", 1, 2), ("n", "d", "answer_lookup", "md", 0, 0)], kinds)
    table = report.count_table(cells)
    assert table.columns == ["format", "answer_lookup", "zz_new"]
    assert {tuple(r) for r in table.filter("format = 'md'").collect()} == {("md", "N/A", "1/2")}
    by = report.percentage_table(cells, by=["model"])
    assert {tuple(r) for r in by.filter("format = 'md'").collect()} == {("m", "md", "N/A", "50.0%"), ("n", "md", "N/A", "N/A")}
    levels = {(r["model"], r["level"], r["total"]) for r in report.report_levels(cells, ["model"]).collect()}
    assert levels == {("m", 0, 2), ("m", 5, 2), ("m", 7, 2), ("n", 0, 0), ("n", 5, 0), ("n", 7, 0)}
