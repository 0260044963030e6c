"""Main text of web pages by gradient-boosted trees over the blocks of the page.

Each block is judged by its element, words of its attributes, depth, density and
neighbours, and a hierarchical decoding picks the likeliest choice in which no
kept block stands in a dropped one.

The trees are trained on a bounded sample of the pages. Blocks below an
``article`` or ``main`` element, and not below a menu, form or the like, count
as article there. The texts are also set in random other layouts, with class names
in place of such elements and with clutter inside the article, so that the trees
learn to do without those elements.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollwright.llm import boosting
from pollwright.llm.common import columns, sample
from pollwright.llm.dom import SIGN_AT, Node, decode, features, parse
from pollwright.llm.layouts import FLAG, Layout

#: Bounds of the training sample: whole pages, layouts of each.
PAGES = 400
LAYOUTS = 4
#: Blocks scored at once.
BLOCKS = 20_000

SEMANTIC = {"article", "main"}
OTHER = {s for s in SIGN_AT if s != "main"}


def in_article(node: Node | None) -> bool | None:
    """What the nearest telling element around says; None if none does."""
    while node is not None:
        if node.tag in SEMANTIC:
            return True
        if any(node.signs[SIGN_AT[s]] for s in OTHER):
            return False
        node = node.parent
    return None


def labelled(nodes: list[Node], holds: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks with text; a block counts if it holds a line that does."""
    number = {id(n): i for i, n in enumerate(nodes)}
    for i in range(len(nodes) - 1, 0, -1):
        if holds[i]:
            holds[number[id(nodes[i].parent)]] = True
    kept = [i for i, n in enumerate(nodes) if n.total]
    x = np.array(features(nodes))
    return x[kept], np.array(holds, float)[kept]


def examples(pages: list[str], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of the pages and of their texts in other layouts."""
    dice = np.random.default_rng(seed)
    known, xs, ys = [], [], []
    for page in pages:
        nodes, lines = parse(page)
        kept = [(i, text) for i, text in lines if in_article(nodes[i])]
        if kept:
            known.append([text for _, text in kept])
            holds = [False] * len(nodes)
            for i, _ in kept:
                holds[i] = True
            x, y = labelled(nodes, holds)
            xs.append(x)
            ys.append(y)
    if not known:
        known = [[t for _, t in parse(p)[1]] or ["-"] for p in pages] or [["-"]]
    prose = [t for texts in known for t in texts if len(t) > 80] or ["-"]
    words = [w for t in prose[:500] for w in t.split()[:20]] or ["-"]
    for texts in known:
        for _ in range(LAYOUTS):
            layout = Layout(dice, words, prose)
            chosen = texts[1:] or texts
            begin = int(dice.integers(max(1, len(chosen) // 2)))
            nodes, lines = parse(layout.page(texts[0], chosen[begin : begin + int(dice.integers(1, 25))]))
            holds = [False] * len(nodes)
            for i, text in lines:
                holds[i] = holds[i] or FLAG in text
            x, y = labelled(nodes, holds)
            if len(x):
                xs.append(x)
                ys.append(y)
    return np.concatenate(xs), np.concatenate(ys)


def learn(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> boosting.Trees:
    """Trees from at most ``PAGES`` whole pages, those of the smallest hash of their id."""
    pages = columns(df, page_id=id_col, html=html_col).filter("length(html) > 0")
    taken = sample(pages, "page_id", PAGES).dropDuplicates(["page_id"])
    found = taken.select("page_id", "html").collect()
    return boosting.fit(*examples([r["html"] for r in sorted(found, key=lambda r: str(r["page_id"]))]))


def chosen_lines(pages: list[str], trees: boosting.Trees) -> list[str]:
    """The kept lines of each page, joined."""
    parsed = [parse(p) for p in pages]
    rows = [r for nodes, _ in parsed for r in features(nodes)]
    odds = trees.score(np.array(rows))
    kept, dropped = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    out, at = [], 0
    for nodes, lines in parsed:
        here = slice(at, at + len(nodes))
        chosen = decode(nodes, kept[here].tolist(), dropped[here].tolist())
        out.append("\n".join(text for i, text in lines if chosen[i]))
        at += len(nodes)
    return out


def extract(
    df: DataFrame, trees: boosting.Trees, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row, from the whole page.

    ``text`` has a line for each kept block: character references are decoded, white space
    is made single blanks. A null or empty page, and one without article, has
    an empty text. Text without markup is kept. Repeated rows come out repeated;
    other columns are left out.
    """
    pages = columns(df, page_id=id_col, url=url_col, html=html_col)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found, block, size = [], [], 0
            for page in batch:
                page = page.as_py() or ""
                block.append(page)
                size += page.count("<") + 1
                if size >= BLOCKS:
                    found += chosen_lines(block, trees)
                    block, size = [], 0
            if block:
                found += chosen_lines(block, trees)
            yield pa.array(found, pa.string())

    return pages.select("page_id", "url", text("html").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
