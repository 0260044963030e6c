"""Whitening, structure repair and quality ranking."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pollwright.llm import queries, ranking, repair, whitening
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.01"


# --- whitening ---------------------------------------------------------------


def brute_whitening(vectors, weights=None):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    deviation = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    fitted = np.unique(x, axis=0) if weights == "one" else x
    mean = fitted.mean(axis=0)
    values, axes = np.linalg.eigh((fitted - mean).T @ (fitted - mean) / len(fitted))
    order = np.argsort(-values)[:32]
    order = order[values[order] > 1e-9 * values.max()]
    return (x - mean) @ axes[:, order] / np.sqrt(values[order]), deviation, values[order] / values.sum()


def matrix_of(rows):
    found = {}
    for r in rows:
        found.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    return {k: np.array([v[c] for c in sorted(v)]) for k, v in found.items()}


def assert_same_whitening(rows, ids, vectors, weights=None):
    want, deviation, share = brute_whitening(vectors, weights)
    got = matrix_of(rows)
    assert set(got) == set(ids)
    mine = np.array([got[i] for i in ids])
    assert mine.shape == want.shape
    signs = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine * signs - want).max() < 1e-6
    assert {r["component"]: r["explained"] for r in rows} == pytest.approx({i + 1: s for i, s in enumerate(share)}, rel=1e-6)
    if weights is None:
        assert {r["vec_id"]: r["deviation"] for r in rows} == dict(zip(ids, deviation.tolist(), strict=True))
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] <= 1e-4


def test_whitening_is_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = queries.op11_multiplicity_whitening(spark, SF).collect()
    assert len(rows) == 32 * len(table) and {r["n"] for r in rows} == {len(table)}
    assert_same_whitening(rows, [r["vec_id"] for r in table], [r["embedding"] for r in table])


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening_of_a_hot_vector(spark, weights):
    """A third of all rows hold one vector; the fit counts each of them, or each distinct vector once."""
    dice = np.random.default_rng(3)
    vectors = [np.full(6, 0.5)] * 1000 + list(dice.normal(size=(2000, 6)))
    vectors = [[float(c) for c in v] for v in vectors]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(7)
    rows = whitening.whiten(df, weights=weights).collect()
    assert_same_whitening(rows, list(range(3000)), vectors, None if weights == "counts" else "one")


def test_whitening_of_odd_rows(spark):
    """Rows without a usable vector, rows of another length, repeated rows, clashing columns."""
    schema = "vec_id long, embedding array<double>, x int, lots int, weight int, rows int"
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [0.5, 3.0])]
    bad = [(5, None), (6, []), (7, [None, 1.0]), (8, [nan, 1.0]), (9, [1.0, -inf]), (10, [1e300, 0.0]), (11, [1.0])]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in good + bad], schema)
    rows = whitening.whiten(df).collect()
    ids = sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in rows)
    assert ids == [(False, 1)] * 2 + [(False, 2)] * 4 + [(True, 0)] * 2 and rows[0]["n"] == 4
    for empty in (df.limit(0), df.filter("vec_id = 1"), df.filter("vec_id = 2"), df.filter("vec_id = 5")):
        assert whitening.whiten(empty).count() == 0


def test_deviations_beyond_64_bits_of_the_middle_steps():
    model = whitening.Whitening(10**9, [10**9 * whitening.OFFSET], np.zeros((1, 0)), np.zeros(0))
    assert model.deviations(np.array([[whitening.OFFSET + 3], [whitening.OFFSET + 10**6]])) == [9 * 10**18, 10**30]


# --- conversations -----------------------------------------------------------


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute_repair(rows):
    """Shortest paths over (cost, edits) as they are spelt, first by cost and then by letters."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not shown else "twice" if (role, text) in seen else "open" if shown[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, edits, i, last = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            break
        if (i, last) in done:
            continue
        done.add((i, last))
        heapq.heappush(heap, (cost + 2, edits + "I", i, after[last]))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, last))
            if faults[i] not in ("blank", "twice"):
                more = faults[i] == "open"
                heapq.heappush(heap, (cost + 2 + more, edits + "R", i + 1, after[last]))
                if (initials[i], last) == ("s", "") or initials[i] == after[last]:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, initials[i]))
    lines, i, last = [], 0, ""
    named = {"u": "user", "a": "assistant"}
    for letter in edits:
        role, text = rows[i][1:] if letter != "I" else ("", "")
        i += letter != "I"
        if letter != "D":
            last = role[0] if letter == "K" else after[last]
            lines.append((role if letter == "K" else named[last]) + ":" + text)
    counts = [faults.count(f) for f in ("blank", "twice", "open")]
    return (gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def brute_report(rows, every=()):
    by = {c: [] for c in [*(r[0] for r in rows), *every]}
    for conv, *rest in rows:
        by[conv].append(tuple(" " if v is None and k else v for k, v in enumerate(rest)))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: brute_repair(sorted(v, key=order)) for c, v in by.items()}


CONVERSATION = "conv_id long, turn long, role string, text string"


def random_rows(dice, conversations, turns):
    texts = ["Yes.", "no", "", " \t", "What?", "A long answer!", "cut off", "é.", None, "Fine. ", ". x"]
    roles = ["system", "user", "assistant", "tool", "", None, "sys", "u", "a"]
    for conv in [*range(conversations), None]:
        for _ in range(dice.randrange(1, turns)):
            yield conv, dice.choice([*range(turns), None]), dice.choice(roles[:3] * 4 + roles), dice.choice(texts)


def test_repair_is_brute_force(spark):
    rows = list(random_rows(random.Random(5), 150, 14))
    df = spark.createDataFrame(rows, CONVERSATION)
    got = {r[0]: tuple(r)[1:] for r in repair.report(df).collect()}
    want = brute_report(rows)
    assert got == {c: report for c, (report, _) in want.items()}
    whole = {}
    for r in repair.repaired(df).orderBy("conv_id", "turn").collect():
        whole.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert whole == {c: lines for c, (_, lines) in want.items() if lines}


@pytest.mark.parametrize("bits", [1, 3])
def test_repair_over_many_segments(spark, monkeypatch, bits):
    """Conversations that lie in several segments, and in several parts of the sorted table."""
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    rows = list(random_rows(random.Random(bits), 4, 90))
    df = spark.createDataFrame(rows, CONVERSATION)
    got = {r[0]: tuple(r)[1:] for r in repair.report(df).collect()}
    assert got == {c: report for c, (report, _) in brute_report(rows).items()}


def test_repair_of_the_damaged_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_structure_repair(spark, SF)
    want = brute_report(brute_damage(rows), {r[0] for r in rows})
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {c: report for c, (report, _) in want.items()}
    assert compare(connect(SF), got, queries.ORACLES["op12_structure_repair"]) is None


def test_repair_of_one_row_repeated(spark):
    """A group of equal rows is counted, not moved; all but the first are deleted."""
    df = spark.createDataFrame([(1, 7, "user", "Hi.")], CONVERSATION).crossJoin(spark.range(5000).select(F.col("id").alias("at")))
    (row,) = repair.report(df).collect()
    assert row["audit"] == "K" + "D" * 4999 + "I" and row["cost"] == 3 * 4999 + 2 and row["duplicate"] == 4999
    assert row["illegal"] == 4999 and row["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:").hexdigest()


def test_repair_of_long_texts_and_other_columns(spark):
    long = "word " * 200_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (2, None, None, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], CONVERSATION + ", kind int, mark int, conv int")
    got = {r[0]: tuple(r)[1:] for r in repair.report(df).collect()}
    assert got == {c: report for c, (report, _) in brute_report(rows).items()}
    assert repair.report(df.limit(0)).count() == 0 and repair.repaired(df.limit(0)).count() == 0
    assert repair.report(repair.damage(df.limit(0)), every=df).count() == 2


def test_matrices_are_walks():
    dice = random.Random(2)
    for _ in range(300):
        codes = bytes(dice.choice([0, 1, 1, 2, 2, 3, 4, 9, 10]) for _ in range(dice.randrange(1, 20)))
        cut = dice.randrange(len(codes))
        whole = repair.backward(codes, repair.END)
        vector, total = repair.backward(codes[cut:], repair.END)
        first, more = repair.before_segment(repair.matrix(codes[:cut]), vector) if cut else (vector, 0)
        assert (first, more + total) == whole


# --- quality -----------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    path = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality")
    rows = queries.op13_pairwise_ranking(spark, path).join(marks, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    good, bad = ([r["score"] for r in held if r["quality"] == k] for k in (1, 0))
    ordered = np.mean([np.mean(np.array(good) > b) + np.mean(np.array(good) == b) / 2 for b in bad])
    assert ordered > 0.995 and np.mean([r["predicted"] == r["quality"] for r in held]) > 0.98


def test_quality_without_and_with_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "A good text. It has words."), (2, "%%% &&& %%%"), (3, None), (4, ""), (None, "x"), (1, "Again a good text.")],
        "doc_id long, text string",
    ).withColumn("label", F.lit(1)).withColumn("raw", F.lit("r"))
    marks = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 0), (3, 1), (None, 1), (9, 1), (4, None)], "doc_id long, quality int")
    for labels, prior in ((marks.limit(0), 0.5), (marks.filter("doc_id = 1"), 1.0), (marks.filter("doc_id = 2"), 0.0)):
        scores = {r["score"] for r in ranking.score(docs, ranking.learn(docs, labels)).collect()}
        assert len(scores) == 1 and scores.pop() == pytest.approx(prior, abs=1e-6)
    assert ranking.score(docs, ranking.learn(docs, marks)).count() == 6
    assert ranking.score(docs, ranking.learn(docs.limit(0), marks)).count() == 6
    assert ranking.score(docs.limit(0), ranking.learn(docs, marks)).count() == 0


def test_every_labelled_text_teaches(spark):
    ids = spark.range(8_700).withColumnRenamed("id", "doc_id")
    last = ids.filter("doc_id >= 300").orderBy(F.xxhash64("doc_id").desc()).limit(400).withColumn("late", F.lit(True))
    marks = ids.select("doc_id", (F.col("doc_id") >= 300).cast("int").alias("quality"))
    plain = F.concat(F.lit("Some words of text number "), F.col("doc_id").cast("string"), F.lit("."))
    text = F.when(F.col("doc_id") < 300, "%% && %%").otherwise(plain)
    docs = ids.join(last, "doc_id", "left")
    same = ranking.learn(docs.select("doc_id", text.alias("text")), marks)
    late = ranking.learn(docs.select("doc_id", F.when(F.col("late"), "% & %").otherwise(text).alias("text")), marks)
    assert not np.array_equal(same.weights, late.weights) and same.threshold != late.threshold


def test_parts_have_a_bounded_number_of_texts(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    fit = ranking.fit

    def counted(better, worse, edges, seed):
        seen.add(1)
        assert len(better) + len(worse) < 100
        return fit(better, worse, edges, seed)

    monkeypatch.setattr(ranking, "STEPS", 2)
    monkeypatch.setattr(ranking, "fit", counted)
    ids = spark.range(600).withColumnRenamed("id", "doc_id")
    docs = ids.select("doc_id", F.expr("if(doc_id % 2 = 0, 'A text.', '% & %')").alias("text"))
    ranking.learn(docs, ids.select("doc_id", (1 - F.col("doc_id") % 2).alias("quality")), part_texts=50)
    assert seen.value == 12


def test_features_of_whole_texts():
    assert ranking.features(None) == ranking.features("") == ranking.features(" \n") == [0.0] * len(ranking.FEATURES)
    short = dict(zip(ranking.FEATURES, ranking.features("One two.\nOne two."), strict=True))
    assert short["repeated_lines"] == 0.5 and short["upper"] == pytest.approx(2 / 12) and short["stopped_lines"] == 1
    long = dict(zip(ranking.FEATURES, ranking.features("word " * 300_000 + "$ " * 300_000), strict=True))
    assert long["lone_marks"] == 0.5 and long["symbols"] == pytest.approx(0.2) and long["adjacent_repeats"] > 0.99


def test_pairs_order_what_differs_in_one_feature():
    dice = np.random.default_rng(1)
    x = dice.random((400, len(ranking.FEATURES)))
    good = x[:, 3] + 0.2 * dice.random(400) > 0.6
    edges = np.tile(np.linspace(0, 1, ranking.BINS + 1)[1:-1], (len(ranking.FEATURES), 1))
    model = ranking.Ranking(edges, ranking.fit(x[good], x[~good], edges, 0), 0.0)
    raw = model.raw(x)
    assert np.mean(raw[good][:, None] > raw[~good][None, :]) > 0.97


def test_threshold_is_the_quantile_of_the_share():
    low, high = np.linspace(-3, -1, 201), np.linspace(1, 5, 201)
    assert ranking.quantile_threshold(low, high, 0.2) == pytest.approx(0)
    same = np.linspace(0, 1, 201)
    assert ranking.quantile_threshold(same, same, 0.3) == pytest.approx(0.3, abs=0.01)
