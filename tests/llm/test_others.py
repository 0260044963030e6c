"""Pages, vectors, shards, conversations, graphs and the pipeline."""

from __future__ import annotations

import html
import itertools
import os
import random
import time
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pollwright.llm import boosting, dom, extraction, graph, layouts, neighbours, perspectives, queries, sharding
from tests.oracle_check import connect

SF = "/root/testdata/sf0.01"


# --- pages -------------------------------------------------------------------


def article_lines(page):
    """What stands in the article element, by a pattern that fits these pages only."""
    inside = page[page.index("<article>") + 9 : page.index("</article>")]
    lines = (html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))) for x in re.split(r"</?(?:p|h[1-6])>", inside))
    return "\n".join(" ".join(x.split()) for x in lines if x.strip())


@pytest.fixture(scope="module")
def trees(spark):
    return extraction.learn(spark.read.parquet(f"{SF}/pages.parquet"))


def test_pages_give_their_articles(spark, trees):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op1_boosted_blocks(spark, SF).collect()
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)
    right = sum(r["text"] == article_lines(pages[r["page_id"]]["html"]) for r in rows)
    assert right >= 0.99 * len(rows)


def test_other_layouts_give_their_articles(spark, trees):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(80).collect()]
    dice, right, total = np.random.default_rng(77), 0, 0
    known = [article_lines(p).split("\n") for p in pages]
    prose = [t for x in known for t in x if len(t) > 80]
    for lines in known * 3:
        layout = layouts.Layout(dice, " ".join(prose[:50]).split(), prose)
        page = layout.page(lines[0], lines[1:20] or lines)
        want = [t for _, t in dom.parse(page)[1] if layouts.FLAG in t]
        got = [t for t in extraction.chosen_lines([page], trees)[0].split("\n") if t]
        right, total = right + (got == want), total + 1
    assert right >= 0.9 * total


CLUTTERED = """<html><head><title>No</title><style>p{}</style></head><body>
<div class="header"><a href="/">Site</a></div><ul class="menu"><li><a href="a">One</a><li><a href="b">Two</a></ul>
<div class="cookie-notice">We use cookies to improve this site. <button>OK</button></div>
<div class="content"><h1>A &lt;title&gt; &amp;amp; more</h1>
<p>First   paragraph of the article,&nbsp;long enough to be read, with commas, and a stop.
<p>Second <b>paragraph</b> of <a href="x">it</a>, which also has words, commas and a full stop.</p>
<div class="ad">Buy now</div><p>Third paragraph<br>of the article, closing what the first two began to say.</p></div>
<div class="comments"><h3>Comments</h3><div class="comment"><p>I liked the second paragraph of this, thank you, and more.</p></div></div>
<form class="newsletter"><label>Mail</label><input></form><script>var a = "<p>no</p>";</script>
<div class="footer">&copy; 2020 Site</div></body></html>"""


def test_clutter_goes_and_text_is_decoded(spark, trees):
    rows = [(1, "u", CLUTTERED), (2, None, None), (3, "u", ""), (4, "u", "just   text"), (4, "u", "just   text"),
            (5, "u", "<div" * 2000), (6, "u", "<p>" + "x " * 200_000), (7, "u", "<!-- open"), (8, "u", '<a b="')]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = extraction.extract(pages, trees).collect()
    assert len(got) == len(rows) and all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1].split("\n") == [
        "A <title> &amp; more",
        "First paragraph of the article, long enough to be read, with commas, and a stop.",
        "Second paragraph of it, which also has words, commas and a full stop.",
        "Third paragraph of the article, closing what the first two began to say.",
    ]
    assert by[2] == by[3] == by[7] == "" and by[4] == "just text" and len(by[6]) == 399_999
    assert extraction.extract(pages.limit(0), trees).count() == 0


def test_trees_learn_from_whole_pages(spark, monkeypatch):
    page = "<main>" + "<p>some words of a long page</p>" * 3_000 + "</main><footer>the end</footer>"
    seen = []
    monkeypatch.setattr(extraction, "examples", lambda pages: (seen.extend(pages), None))
    monkeypatch.setattr(extraction.boosting, "fit", lambda x, y: None)
    extraction.learn(spark.createDataFrame([(1, page)], "page_id long, html string"))
    assert seen == [page] and len(page) > 30_000


def test_choices_do_not_contradict():
    dice = random.Random(6)
    for _ in range(40):
        page = "<div>x" * 1 + "".join(dice.choice(("<div>a", "</div>", "<p>b", "</p>", "<section>c")) for _ in range(8))
        nodes, _ = dom.parse(page)
        odds = [dice.gauss(0, 2) for _ in nodes]
        kept, dropped = [-np.logaddexp(0, -o) for o in odds], [-np.logaddexp(0, o) for o in odds]
        number = {id(n): i for i, n in enumerate(nodes)}

        def fits(choice):
            return all(n.parent is None or choice[number[id(n.parent)]] or not choice[i] for i, n in enumerate(nodes))

        def worth(choice):
            return sum(k if c else d for c, k, d in zip(choice, kept, dropped, strict=True))

        got = dom.decode(nodes, kept, dropped)
        assert fits(got)
        best = max(worth(c) for c in itertools.product((True, False), repeat=len(nodes)) if fits(c))
        assert worth(got) == pytest.approx(best)


@pytest.mark.parametrize("times", [1, 60])
def test_features_of_siblings_do_not_change_with_their_number(times):
    nodes, _ = dom.parse("<div>" + "<p>a</p><p>b</p><ul><li>c</li></ul><h2>d</h2>" * times + "</div>")
    beside = [i for i, n in enumerate(nodes) if n.parent is not None and n.parent.tag == "div"]
    assert len(beside) == 4 * times
    alike = dom.N_KINDS + 2 * len(dom.SIGNS) + 14
    rows = dom.features(nodes)
    assert [rows[i][alike] for i in beside] == [0.5, 0.5, 0.25, 0.25] * times


def test_trees_learn_what_no_single_split_tells():
    dice = np.random.default_rng(0)
    x = dice.random((3000, 5))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    score = boosting.fit(x[:2000], y[:2000], trees=40).score(x[2000:])
    assert ((score > 0) == y[2000:]).mean() > 0.95


# --- vectors -----------------------------------------------------------------


def nearest(ids, vectors, asked, k):
    found = {}
    for q in asked:
        scores = vectors @ vectors[ids.index(q)]
        order = sorted((i for i, v in enumerate(ids) if v != q), key=lambda i: (-scores[i], ids[i]))[:k]
        found[q] = [ids[i] for i in order]
    return found


def test_neighbours_reach_the_recall(spark):
    path = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    got = queries.op9_multi_index_hashing(spark, path).collect()
    asked = [i for i in ids if i % 20 == 0]
    want = nearest(ids, vectors, asked, 20)
    place = {v: i for i, v in enumerate(ids)}
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
        assert r["score"] == pytest.approx(float(vectors[place[r["query_id"]]] @ vectors[place[r["vec_id"]]]), abs=1e-12)
    assert set(found) == set(asked) and all(sorted(f) == list(range(1, 21)) for f in found.values())
    recall = np.mean([len(set(found[q].values()) & set(want[q])) / 20 for q in asked])
    assert recall >= 0.95


def test_exact_search_is_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    got = neighbours.exact(spark.read.parquet(f"{SF}/embeddings.parquet"), "vec_id % 20 = 0")
    want = nearest(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    assert {r["query_id"]: r["l"] for r in got.groupBy("query_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "vec_id"))), lambda x: x["vec_id"]).alias("l")
    ).collect()} == want


def test_every_code_in_the_radius_is_retrieved():
    dice = np.random.default_rng(9)
    codes = dice.integers(0, 256, (3000, 8), dtype=np.uint8)
    codes[:200] = codes[0]
    codes[100:200, 3] ^= 1
    index = neighbours.MultiIndex(codes)
    for q in (codes[0], codes[150], codes[2500]):
        for enough in (1, 50, 400, 3000):
            far = neighbours.BYTE_BITS[codes ^ q].sum(axis=1)
            radius = np.sort(far)[enough - 1]
            assert sorted(index.within(q, enough).tolist()) == np.flatnonzero(far <= radius).tolist()


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (2, [0.5, 0.5]), (20, [1.0, 0.0])]
    table = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "vec_id long, embedding array<float>, rank int, score double")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search(table, "vec_id % 20 = 0").collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 20), (0, 3, 2), (20, 1, 0), (20, 2, 1), (20, 3, 2)]
    assert neighbours.search(table.limit(0), "vec_id % 20 = 0").count() == 0
    assert neighbours.search(table.filter("vec_id in (3, 4)"), "vec_id % 20 = 0").count() == 0


# --- shards ------------------------------------------------------------------


@pytest.mark.parametrize("limit", [2_000, 30_000, 400_000])
def test_shards_match_sums_of_all_prefixes(spark, limit):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = connect(SF)
    want = con.execute(f"SELECT doc_id, n_bytes, shard, shard_depth, shard_bytes FROM ({sharding.oracle(limit)})").fetchall()
    got = sharding.assign(docs, limit).collect()
    small = {r["doc_id"] for r in got if r["n_bytes"] <= limit}
    # a text over the limit has a page of its own, which the sums don't know
    assert {tuple(r) for r in got if r["doc_id"] in small} == {w for w in want if w[0] in small}
    assert len(got) == 1000 and all(r["shard_bytes"] <= limit for r in got if r["doc_id"] in small)


def test_copies_are_dealt_over_pages(spark, tmp_path):
    rows = [(1, "x" * 10)] * 25 + [(1, "y" * 10), (2, None), (None, "z"), (3, ""), (4, "w" * 500)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, shard int")
    got = sharding.assign(docs.drop("shard"), 40).collect()
    assert len(got) == len(rows)
    held = {}
    for r in got:
        held.setdefault(r["shard"], []).append(r)
    for shard, members in held.items():
        total = sum(r["n_bytes"] for r in members)
        assert total == members[0]["shard_bytes"] and (total <= 40 or len(members) == 1), shard
    sharding.write(docs.drop("shard"), str(tmp_path / "out"), 40)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    assert sharding.assign(docs.limit(0), 40).count() == 0


@pytest.mark.parametrize("part_rows", [4, 100_000])
def test_shards_hold_the_rows_themselves(spark, tmp_path, monkeypatch, part_rows):
    """Rows that share id and text keep their other columns; null and empty texts are two rows."""
    monkeypatch.setattr(sharding, "PART_ROWS", part_rows)
    rows = [(1, None, "a"), (1, "", "b"), (2, "x", "left"), (2, "x", "right"), (None, "x", None)]
    rows += [(3, "y" * 10, str(i)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _code string").withColumn("shard", F.lit(5)).repartition(3)
    sharding.write(docs, str(tmp_path / "out"), 40)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["_code"]) for r in back.collect()))) == sorted(map(repr, rows))
    sizes = back.groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n")).collect()
    assert all(r["n"] <= 40 for r in sizes) and len(sizes) >= 8


# --- conversations -----------------------------------------------------------


def test_perspectives(spark):
    rows = [(1, 2, "bob", "hi"), (1, 1, "ann", "hello é"), (1, 0, "system", "be kind"), (1, 3, None, None),
            (2, 0, "system", "alone"), (None, 0, "ann", "lost"), (3, 5, "ann", "a"), (3, 5, "ann", "a"), (3, None, "cy", "b")]
    turns = spark.createDataFrame([(*r, 1, "p") for r in rows], "conv_id long, turn long, role string, text string, piece int, perspective string")
    got = {(r["conv_id"], r["perspective"], r["block"]): r for r in perspectives.rotate(turns).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (3, "ann", 0), (3, "cy", 0), (3, "ann", None), (3, "cy", None)}
    ann = got[1, "ann", 0]
    assert ann["text"] == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhello é<|im_end|>\n"
        "<|im_start|>user name=bob\nhi<|im_end|>\n<|im_start|>user name=unknown\n<|im_end|>\n"
    )
    assert [ann["text"][s["start"] : s["stop"]] for s in ann["spans"]] == ["hello é<|im_end|>"]
    bob = got[1, "bob", 0]
    assert [bob["text"][s["start"] : s["stop"]] for s in bob["spans"]] == ["hi<|im_end|>"]
    assert got[3, "ann", 0]["n_turns"] == 2 and got[3, "cy", 0]["spans"] == []
    assert perspectives.rotate(turns.limit(0)).count() == 0


def test_turns_without_speaker_are_not_those_of_a_participant_called_unknown(spark):
    rows = [(1, 0, "unknown", "mine"), (1, 1, None, "nobody's"), (1, 2, "ann", "hers")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = perspectives.rotate(turns).filter("perspective = 'unknown'").collect()
    assert row["text"] == (
        "<|im_start|>assistant\nmine<|im_end|>\n<|im_start|>user name=unknown\nnobody's<|im_end|>\n"
        "<|im_start|>user name=ann\nhers<|im_end|>\n"
    )
    assert [row["text"][s["start"] : s["stop"]] for s in row["spans"]] == ["mine<|im_end|>"]


def test_long_conversations_come_in_parts(spark):
    rows = [(1, t, f"s{t % 3}", str(t)) for t in range(200)] + [(2, 7, "a", str(i)) for i in range(150)]
    got = perspectives.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all(r["n_turns"] <= perspectives.PART_TURNS for r in got)
    for p in ("s0", "s1", "s2"):
        parts = sorted((r for r in got if r["perspective"] == p), key=lambda r: (r["block"], r["piece"]))
        said = re.findall(r"\n(\d+)<\|im_end\|>", "".join(r["text"] for r in parts))
        assert said == [str(t) for t in range(200)] and sum(len(r["spans"]) for r in parts) in (66, 67)
    assert sorted(r["n_turns"] for r in got if r["conv_id"] == 2) == [22, 64, 64]


def test_perspectives_run_no_python(spark):
    plan = queries.op10_perspectives(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- graph and pipeline ------------------------------------------------------


def test_components(spark):
    dice = random.Random(1)
    links = [(dice.randrange(300), dice.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    links += [(500, i) for i in range(501, 540)] + [(7, 7), (None, 3)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    got = graph.components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {x: find(x) for x in top}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stages_work_on_what_is_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(5000, None, "en", "s", 0), (5001, "", "en", "s", 0), (5002, "12 34", None, "s", 5),
             (0, "twice", "fr", "s", 5), (None, "Is and retitioning ouen the of, nterti", "en", "s", 38)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        docs = docs.checkpoint() if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else docs.cache()
        sizes.append(docs.count())
        if name != "encoding":
            assert docs.columns == before.columns and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
            assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
    assert sizes[1] == sizes[0] - 3 and sizes[2] < sizes[1] and sizes[3] <= sizes[2] and sizes[4] < sizes[3] == sizes[3]
    assert sizes[5] == sizes[4] and set(docs.columns) == {"doc_id", "ids", "n_tokens", "decoded"}


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


@pytest.mark.parametrize("also", ["corpus_pipeline.py", None])
def test_the_entry_works_without_this_package(tmp_path, also):
    top = Path(__file__).resolve().parents[2]
    skipped = {"llm", ".git", "__pycache__", also}
    for path in top.rglob("*.py"):
        relative = path.relative_to(top)
        if not skipped & set(relative.parts):
            (tmp_path / relative).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / relative).write_text(path.read_text())
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith('op')])"],
        cwd=tmp_path, capture_output=True, text=True, timeout=120,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert said.returncode == 0 and int(said.stdout.split()[0]) > 80 and "[]" in said.stdout, said.stderr


def test_models_without_data(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    trees = extraction.learn(pages.limit(0))
    assert extraction.extract(pages.limit(3), trees).count() == 3


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        ("<script src=/a/>var x=1;</script><p>two", ["two"]),
        ("<script async />x</script>a", ["a"]),
        ("<!--><p>two</p><!-- c -->", ["two"]),
        ("<!---><p>two", ["two"]),
        ("x<!--a--!>y", ["xy"]),
        ("a<!-- b > c", ["a"]),
        ("<!-- a >-->z", ["z"]),
        ("<![CDATA[ x ><p>two</p>", ["two"]),
        ("<p>a <a \"x", ["a <a \"x"]),
        ("<a href=\"x>y", ["y"]),
        ("<b><p><span>x</b>y", ["xy"]),
        ("", []),
    ],
)
def test_malformed_pages_end_as_in_html(page, lines):
    assert [t for _, t in dom.parse(page)[1]] == lines


@pytest.mark.parametrize("unit", ["<a \"x", "<span>x</b>", "<b><p><span></b>", "<div><option></option>", "<head>", "<a x=\"b>"])
def test_broken_markup_takes_linear_time(unit):
    def seconds(n: int) -> float:
        start = time.process_time()
        dom.parse(unit * n)
        return time.process_time() - start

    assert seconds(40_000) < 12 * seconds(8_000) + 0.5
