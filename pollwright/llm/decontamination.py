"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over neighbouring words; words at its zeros don't count.
Seeds of all training texts meet those of the test items by hash, and around
each hit the text is compared with the item word by word, so that passages with
some words substituted are found too. The masks of ``MASKS`` hit every run of
13 words that has at most two substitutions.

All of it is DataFrame operations. Seeds of the texts are made and probed inside
one stage while the seeds of the items fit a broadcast; beyond that both sides
are shuffled by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollwright.llm.common import columns, small

MASKS = ("11010111", "111100101")
#: An overlap is a run of so many words of which this share are the same.
WINDOW = 13
SHARE = 0.8
#: Items under the window count only as a whole; shorter ones than this never do.
SHORTEST = 5


def word_hashes(text: Column) -> Column:
    """A hash for each lower-case word; words are runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(parts, ""), lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, masks: list[str], keep: list[str], wanted: Column | None = None) -> DataFrame:
    """``keep``, ``_at`` and ``_seed`` for each position and mask that fits ``_h`` there."""
    n = F.size("_h")
    at = rows.filter(n > 0).withColumn("_at", F.explode(F.sequence(F.lit(0), n - 1)))
    found = []
    for mask in masks:
        picked = [F.get("_h", F.col("_at") + i) for i, x in enumerate(mask) if x == "1"]
        fits = F.col("_at") + len(mask) <= F.size("_h")
        if set(mask) == {"1"} and wanted is not None:  # a whole short item
            fits = (F.col("_at") == 0) & (wanted == len(mask))
        elif wanted is not None:
            fits = fits & (wanted >= WINDOW)
        found.append(F.when(fits, F.xxhash64(F.lit(mask), *picked)))
    return at.withColumn("_seed", F.explode(F.array(*found))).filter("_seed is not null").select(
        *keep, "_at", "_seed"
    )


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: float = SHARE,
) -> DataFrame:
    """``doc_id, item_id, doc_start, item_start, n_words, n_same``: passages of items in texts.

    Word ``doc_start`` of the text stands where word ``item_start`` of the item
    does (both from 0) and so on for ``n_words`` words, first and last the same,
    ``n_same`` in all. Such a stretch joins the runs of ``window`` words of which
    at least ``share`` are the same. An item with fewer words must occur as a
    whole, unchanged; one with under ``SHORTEST`` words is not searched. An
    insertion in the passage gives two rows. Null and empty texts, and an empty
    table on either side, give no rows. Repeated rows of a text or an item
    give their rows once, as ids tell texts apart. Other columns are left out.
    """
    texts = columns(docs, doc_id=id_col, _text=text_col).filter("_text is not null").select(
        "doc_id", word_hashes(F.col("_text")).alias("_h")
    )
    tests = columns(items, item_id=item_col, _text=item_text_col).select(
        "item_id", word_hashes(F.col("_text")).alias("_item")
    ).distinct().filter(F.size("_item") >= SHORTEST)
    lengths = sorted(
        r[0] for r in tests.select(F.size("_item").alias("n")).filter(F.col("n") < window)
        .distinct().collect()  # at most one for each length under the window
    )
    masks = [*MASKS, *("1" * n for n in lengths)]
    item_seeds = seeds(
        tests.withColumnRenamed("_item", "_h"), masks, ["item_id"], F.size("_h")
    ).withColumnRenamed("_at", "_item_at").distinct()

    hits = seeds(texts, masks, ["doc_id", "_h"]).join(small(item_seeds), "_seed")
    shift = F.col("_at") - F.col("_item_at")
    # what of the text can lie beside the item; the join below cuts it to the item's length
    near = hits.select("doc_id", "item_id", "_h", shift.alias("_shift")).join(
        small(tests), "item_id"
    ).withColumn("_from", F.greatest(-F.col("_shift"), F.lit(0)))
    length = F.least(
        F.size("_item") - F.col("_from"), F.size("_h") - F.greatest("_shift", F.lit(0))
    )
    beside = near.select(
        "doc_id", "item_id", "_shift", "_from", "_item",
        F.slice("_h", F.greatest("_shift", F.lit(0)) + 1, length).alias("_part"),
    ).distinct()

    same = F.zip_with(
        "_part", F.slice("_item", F.col("_from") + 1, F.size("_part")),
        lambda a, b: (a == b).cast("int"),
    )
    width = F.least(F.size("_item"), F.lit(window))
    compared = beside.select("*", same.alias("_same"), width.alias("_width")).filter(
        F.size("_same") >= F.col("_width")
    )
    need = F.when(F.size("_item") < window, F.size("_item")).otherwise(
        F.lit(-int(-window * share // 1))
    )
    starts = F.filter(
        F.sequence(F.lit(1), F.size("_same") - F.col("_width") + 1),
        lambda s: F.aggregate(
            F.slice("_same", s, F.col("_width")), F.lit(0), lambda x, y: x + y
        ) >= need,
    )
    runs = compared.select("*", starts.alias("_starts")).filter(F.size("_starts") > 0)
    # the runs of a shift that touch or overlap form one stretch each
    ends = F.transform("_starts", lambda s: F.struct(s.alias("a"), (s + F.col("_width")).alias("b")))
    joined = F.aggregate(
        ends,
        F.array().cast("array<struct<a:int,b:int>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["a"] <= F.element_at(done, -1)["b"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(done, -1)["a"].alias("a"), x["b"].alias("b"))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    stretches = runs.withColumn("_run", F.explode(joined))
    a, b = F.col("_run.a"), F.col("_run.b")
    inside = stretches.withColumn("_in", F.slice("_same", a, b - a)).withColumn(
        "_lead", (F.array_position("_in", 1) - 1).cast("int")
    ).withColumn("_tail", (F.array_position(F.reverse("_in"), 1) - 1).cast("int"))
    begin = a - 1 + F.col("_lead")
    return inside.select(
        "doc_id", "item_id",
        (F.greatest("_shift", F.lit(0)) + begin).alias("doc_start"),
        (F.col("_from") + begin).alias("item_start"),
        (F.size("_in") - F.col("_lead") - F.col("_tail")).alias("n_words"),
        F.aggregate("_in", F.lit(0), lambda x, y: x + y).alias("n_same"),
    ).distinct()


def oracle(window: int = WINDOW, share: float = SHARE) -> str:
    """The same by comparing every text with every item at every shift."""
    need = -int(-window * share // 1)

    def words(of: str, key: str) -> str:
        return f"""SELECT {key}, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
            lambda x: x <> '') AS w FROM (SELECT DISTINCT {key}, text FROM {of} WHERE text IS NOT NULL)"""

    return f"""
WITH docs AS ({words("documents", "doc_id")}),
items AS (SELECT * FROM ({words("benchmark", "item_id")}) WHERE len(w) >= {SHORTEST}),
d AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs),
t AS (SELECT item_id, len(w) AS m, unnest(w) AS word, unnest(range(len(w))) AS j FROM items),
same AS (SELECT doc_id, item_id, n, m, i - j AS shift, j FROM d JOIN t USING (word)),
near AS (SELECT doc_id, item_id, any_value(n) AS n, any_value(m) AS m, shift, list(j) AS js
    FROM same GROUP BY doc_id, item_id, shift
    HAVING count(*) >= least(any_value(m), {need})),
starts AS (SELECT *, unnest(range(greatest(0, -shift),
    least(m, n - shift) - least(m, {window}) + 1)) AS s FROM near),
good AS (SELECT * FROM starts WHERE len(list_filter(js, lambda x: x >= s AND x < s + least(m, {window})))
    >= CASE WHEN m < {window} THEN m ELSE {need} END),
marked AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id, item_id, shift ORDER BY s)
    <= least(m, {window}) THEN 0 ELSE 1 END AS opens FROM good),
grouped AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, item_id, shift ORDER BY s) AS g
    FROM marked),
hull AS (SELECT doc_id, item_id, shift, any_value(js) AS js, min(s) AS a,
    max(s) + any_value(least(m, {window})) AS b FROM grouped GROUP BY doc_id, item_id, shift, g),
inside AS (SELECT doc_id, item_id, shift, list_filter(js, lambda x: x >= a AND x < b) AS js FROM hull)
SELECT doc_id, item_id, CAST(list_min(js) + shift AS INTEGER) AS doc_start,
    CAST(list_min(js) AS INTEGER) AS item_start,
    CAST(list_max(js) - list_min(js) + 1 AS INTEGER) AS n_words, CAST(len(js) AS INTEGER) AS n_same
FROM inside"""
