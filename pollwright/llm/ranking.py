"""Quality scores by Bradley-Terry pairwise ranking.

A document of label 1 is preferred to one of label 0. The log odds of a
preference are the difference of two scores, and a score is a sum over the
features of a text, each cut into bins; its weights minimise the logistic loss on the
differences of features of preference pairs. All labelled texts are dealt over parts;
a ranking from the pairs of each is fitted in parallel tasks, and the rankings are averaged.
The threshold is the quantile of the scores of all labelled texts below which the share of
label 0 lies.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollwright.llm.common import columns, cut, small

#: Labelled texts of a part, about, and the least number of parts.
PART_TEXTS = 4000
RANKINGS = 4
BINS = 16
#: Pairs a document of a part is in, full steps, step size, pull of the weights to zero.
PAIRS_EACH = 4
STEPS = 200
RATE = 0.1
RIDGE = 1e-3
#: Scores of each label are summed up by so many quantiles.
QUANTILES = 200

FEATURES = (
    "chars", "words", "word_length", "long_words", "distinct_words", "commonest_word", "repeated_pairs",
    "adjacent_repeats", "upper", "digits", "stops", "commas", "other_marks", "symbols", "marked_words",
    "lone_marks", "spaces", "line_words", "repeated_lines", "stopped_lines", "letter_spread",
)
SPACE, LOWER, UPPER, DIGIT, STOP, COMMA, MARK, SYMBOL = range(8)


@cache
def kinds() -> np.ndarray:
    """What each code point is; those above the basic plane count as letters."""
    table = np.full(0x10001, LOWER, np.uint8)
    for code in range(0x10000):
        letter = unicodedata.category(chr(code))
        if letter[0] in "ZC":
            table[code] = SPACE
        elif letter in ("Lu", "Lt"):
            table[code] = UPPER
        elif letter[0] == "N":
            table[code] = DIGIT
        elif letter[0] == "P":
            table[code] = MARK
        elif letter[0] == "S":
            table[code] = SYMBOL
    for kind, marks in ((STOP, ".!?"), (COMMA, ",;:")):
        table[[ord(c) for c in marks]] = kind
    return table


def features(text: str | None) -> list[float]:
    """``FEATURES`` of a whole text; a null text counts as empty, and an empty one has only zeros."""
    text = text or ""
    words = text.lower().split()
    if not words:
        return [0.0] * len(FEATURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds()[np.minimum(codes, 0x10000)]
    of_kind = np.bincount(kind, minlength=8)
    letters = of_kind[LOWER] + of_kind[UPPER]
    shown = max(1, len(text) - of_kind[SPACE])
    seen = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    lines = [line for line in map(str.strip, text.splitlines()) if line]
    marked = sum(n for word, n in seen.items() if not word[:-1].isalnum() and len(word) > 1)
    lone = sum(n for word, n in seen.items() if not any(map(str.isalnum, word)))
    spread = np.bincount(np.minimum(codes[kind != SPACE], 0x3FF), minlength=0x400) / shown
    n = len(words)
    return [
        np.log1p(len(text)),
        np.log1p(n),
        sum(len(w) * k for w, k in seen.items()) / n,
        sum(k for w, k in seen.items() if len(w) > 12) / n,
        len(seen) / n**0.8,
        seen.most_common(1)[0][1] / n,
        1 - len(pairs) / max(1, n - 1),
        sum(k for (a, b), k in pairs.items() if a == b) / n,
        of_kind[UPPER] / max(1, letters),
        of_kind[DIGIT] / shown,
        of_kind[STOP] / n,
        of_kind[COMMA] / n,
        of_kind[MARK] / shown,
        of_kind[SYMBOL] / shown,
        marked / n,
        lone / n,
        of_kind[SPACE] / len(text),
        np.log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(line[-1] in ".!?" for line in lines) / max(1, len(lines)),
        float(-(spread[spread > 0] * np.log(spread[spread > 0])).sum()),
    ]


@dataclass
class Ranking:
    """Borders of the bins of each feature, a weight a bin, and the threshold."""

    edges: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Bradley-Terry scores of rows of features."""
        at = binned(x, self.edges)
        return self.weights[np.arange(len(FEATURES)), at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.threshold, -30, 30)))


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])


def fit(better: np.ndarray, worse: np.ndarray, edges: np.ndarray, seed: int) -> np.ndarray:
    """A weight for each feature and bin, from random pairs of a better and a worse row.

    Each row is in ``PAIRS_EACH`` pairs at least. The mean of ``log(1 + exp(-(s_better -
    s_worse)))`` over the pairs is lowered by Adam steps over all of them.
    """
    width = len(edges) * BINS
    weights = np.zeros(width)
    if not len(better) or not len(worse):
        return weights.reshape(len(edges), BINS)
    dice = np.random.default_rng(seed)
    size = PAIRS_EACH * max(len(better), len(worse))
    base = np.arange(len(edges)) * BINS
    up, down = (
        binned(x, edges)[dice.permutation(np.arange(size) % len(x))] + base for x in (better, worse)
    )
    mean, square = np.zeros(width), np.zeros(width)
    for step in range(1, STEPS + 1):
        gap = weights[up].sum(axis=1) - weights[down].sum(axis=1)
        pull = -1 / (1 + np.exp(np.clip(gap, -30, 30))) / size
        share = np.repeat(pull, len(edges))
        slope = np.bincount(up.ravel(), share, width) - np.bincount(down.ravel(), share, width)
        slope += RIDGE * weights
        mean += 0.1 * (slope - mean)
        square += 0.001 * (slope * slope - square)
        weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights.reshape(len(edges), BINS)


def quantile_threshold(low: np.ndarray, high: np.ndarray, share: float) -> float:
    """The score below which ``share`` of the documents lie: ``share`` of all are as ``low``, the others as ``high``.

    ``low`` and ``high`` are the quantiles of the scores of either label. Where no
    score lies between two values, the middle of them is taken.
    """
    steps = np.linspace(0, 1, len(low))
    at = np.unique(np.concatenate([low, high]))
    below = [share * np.interp(at, low, steps, 0, 1), (1 - share) * np.interp(at, high, steps, 0, 1)]
    total = sum(below)
    begin = at[total <= share + 1e-9]
    end = at[total >= share - 1e-9]
    return float((begin[-1] if len(begin) else at[0]) + (end[0] if len(end) else at[-1])) / 2


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    part_texts: int = PART_TEXTS,
) -> Ranking:
    """A ranking from all labelled texts, in as many parts as have about ``part_texts`` each.

    Rows without id or label teach nothing, nor do ids with both
    labels; a null text counts as empty. Without texts of both labels all scores
    are the share of label 1 (0.5 without any).
    """
    texts = columns(docs, doc_id=id_col, text=text_col).filter("doc_id is not null")
    marks = (
        columns(labels, doc_id=id_col, label=label_col)
        .filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_max"))
        .filter("label = _max").drop("_max")
    )
    known = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}  # two rows
    share = known.get(0, 0) / max(1, sum(known.values()))
    parts = max(RANKINGS, -(-sum(known.values()) // part_texts))
    wide = f"doc_id long, label int, {', '.join(f'{f} double' for f in FEATURES)}"

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([features(t) for t in batch["text"]], columns=list(FEATURES))
            yield pd.concat([batch[["doc_id", "label"]].reset_index(drop=True), rows], axis=1)

    rows = cut(
        texts.join(small(marks), "doc_id")
        .select(F.col("doc_id").cast("long"), F.col("label").cast("int"), "text").mapInPandas(describe, wide)
    )
    spots = F.array(*(F.lit(k / BINS) for k in range(1, BINS)))
    cuts = rows.agg(*(F.percentile_approx(f, spots, F.lit(1000)).alias(f) for f in FEATURES)).first()
    if cuts[0] is None or len(known) < 2:
        mean = 1 - share if known else 0.5
        odds = float(np.log(np.clip(mean, 1e-9, 1 - 1e-9) / np.clip(1 - mean, 1e-9, 1)))
        return Ranking(np.zeros((len(FEATURES), BINS - 1)), np.zeros((len(FEATURES), BINS)), -odds)
    edges = np.array([cuts[f] for f in FEATURES])

    def rank(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id")
        better, worse = (part.loc[part["label"] == k, list(FEATURES)].to_numpy() for k in (1, 0))
        lot = int(part["lot"].iloc[0])
        return pd.DataFrame({
            "lot": [lot], "usable": [bool(len(better) and len(worse))],
            "weights": [fit(better, worse, edges, lot).tobytes()],
        })

    lot = F.pmod(F.xxhash64("doc_id", F.lit("lot")), F.lit(parts)).cast("int").alias("lot")
    fitted = (
        rows.select("*", lot).groupBy("lot").applyInPandas(rank, "lot int, usable boolean, weights binary")
        .filter("usable").collect()  # one row a ranking
    )
    shape = (len(FEATURES), BINS)
    each = [np.frombuffer(r["weights"]).reshape(shape) for r in sorted(fitted, key=lambda r: r["lot"])]
    ranking = Ranking(edges, np.mean(each, axis=0) if each else np.zeros(shape), 0.0)

    @F.pandas_udf("double")
    def raw(x: pd.DataFrame) -> pd.Series:
        return pd.Series(ranking.raw(x[list(FEATURES)].to_numpy()))

    steps = F.array(*(F.lit(k / QUANTILES) for k in range(QUANTILES + 1)))
    scored = rows.select("label", raw(F.struct(*FEATURES)).alias("raw"))
    found = scored.groupBy("label").agg(F.percentile_approx("raw", steps, F.lit(10000)).alias("q"))
    quantiles = {r["label"]: np.array(r["q"]) for r in found.collect()}  # two rows
    if len(quantiles) == 2:
        ranking.threshold = quantile_threshold(quantiles[0], quantiles[1], share)
    return ranking


def score(df: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row, from the whole text.

    0.5 and more is above the threshold. A null or empty text gets the score of a
    text without features. Repeated rows come out repeated; other columns are
    left out.
    """
    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch]).reshape(-1, len(FEATURES))
            yield pa.array(ranking.score(x), pa.float64())

    return columns(df, doc_id=id_col, text=text_col).select("doc_id", judge("text").alias("score"))
