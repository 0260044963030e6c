"""Toxicity scores by non-negative positive-unlabelled learning.

A linear classifier is trained from texts confirmed as toxic and from
unlabelled texts. The risk of the negative class is estimated from the
unlabelled texts less the share of toxic ones among them, and kept from going
below zero. Several classifiers, each on its own part of the sample, are trained
in parallel tasks and their scores averaged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollwright.llm.common import columns, sample, semi_join

BUCKET_BITS = 18
#: Word parts of these lengths are features, besides the word itself.
PARTS = (4, 5)
#: Bounds of the training sample: texts confirmed toxic, unlabelled texts, words of a text.
POSITIVES = 3000
UNLABELLED = 9000
CLASSIFIERS = 3
EPOCHS = 30
BATCH = 128
RATE = 0.05
DECAY = 1e-3
#: How many standard deviations the shares of texts with a feature must differ by.
DEVIATIONS = 4.0
#: Words a task remembers the features of, and the longest of them.
HELD_WORDS = 200_000
HELD_CHARS = 64

WORD = re.compile(r"\w+")


def word_features(word: str) -> tuple[int, ...]:
    """Hashed buckets of a word and its parts."""
    import xxhash

    parts = {word[i : i + n] for n in PARTS for i in range(len(word) - n + 1)}
    parts.add(f"<{word}>")
    return tuple(xxhash.xxh32_intdigest(part) >> (32 - BUCKET_BITS) for part in parts)


class Features:
    """Buckets of the words of a text; those of each distinct word are remembered.

    With ``telling``, only these buckets count.
    """

    def __init__(self, telling: set[int] | None = None) -> None:
        self.telling = telling
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            found = word_features(word)
            if self.telling is not None:
                found = tuple(x for x in found if x in self.telling)
            if len(word) <= HELD_CHARS:
                self.known[word] = found
        return found

    def of_text(self, text: str | None) -> set[int]:
        found = set().union(*map(self.of_word, set(WORD.findall((text or "").lower()))))
        if len(self.known) > HELD_WORDS:
            self.known.clear()
        return found


@dataclass
class Sparse:
    """Rows of distinct buckets, one after another."""

    buckets: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Sparse:
        flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
        return cls(flat, np.cumsum([len(r) for r in rows], dtype=np.int64))

    def take(self, chosen: np.ndarray) -> Sparse:
        starts = np.concatenate([[0], self.ends[:-1]])
        return Sparse.of([self.buckets[starts[i] : self.ends[i]] for i in chosen])

    def only(self, kept: np.ndarray) -> Sparse:
        here = kept[self.buckets]
        before = np.concatenate([[0], np.cumsum(here)])
        return Sparse(self.buckets[here], before[self.ends])

    def __len__(self) -> int:
        return len(self.ends)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.buckets])])
        return total[self.ends] - total[np.concatenate([[0], self.ends[:-1]]).astype(int)]

    def spread(self, values: np.ndarray, size: int) -> np.ndarray:
        lengths = np.diff(np.concatenate([[0], self.ends]))
        return np.bincount(self.buckets, np.repeat(values, lengths), minlength=size)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(positive: Sparse, unlabelled: Sparse, size: int) -> np.ndarray:
    """Whether the texts of both samples differ by ``DEVIATIONS`` in how many have a bucket."""
    n_p, n_u = len(positive), len(unlabelled)
    with_p, with_u = (x.spread(np.ones(len(x)), size) for x in (positive, unlabelled))
    share = (with_p + with_u) / (n_p + n_u)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_p + 1 / n_u))
    return np.abs(with_p / n_p - with_u / n_u) >= DEVIATIONS * spread


def train(positive: Sparse, unlabelled: Sparse, prior: float, seed: int) -> np.ndarray:
    """Weights of the buckets and, last, the offset; sigmoid loss, Adam steps.

    Risk: ``prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)])``. While
    the second part is below zero, a step lowers its absolute value instead.
    Buckets that tell the samples not apart have weight 0.
    """
    size = 1 << BUCKET_BITS
    if not len(positive) or not len(unlabelled):
        return np.append(np.zeros(size), np.log(prior / (1 - prior)))
    kept = telling(positive, unlabelled, size)
    positive, unlabelled = positive.only(kept), unlabelled.only(kept)
    dice = np.random.default_rng(seed)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    mean, square, t = np.zeros_like(w), np.zeros_like(w), 0
    rounds = max(1, len(unlabelled) // BATCH)
    for _ in range(EPOCHS):
        p_order = np.array_split(dice.permutation(len(positive)), rounds)
        u_order = np.array_split(dice.permutation(len(unlabelled)), rounds)
        for p_part, u_part in zip(p_order, u_order, strict=True):
            if not len(p_part) or not len(u_part):
                continue
            p, u = positive.take(p_part), unlabelled.take(u_part)
            z_p, z_u = p.sums(w[:-1]) + w[-1], u.sums(w[:-1]) + w[-1]
            s_p, s_u = sigmoid(z_p), sigmoid(z_u)
            up, down = prior * s_p * (1 - s_p) / len(p), s_u * (1 - s_u) / len(u)
            if s_u.mean() - prior * s_p.mean() >= 0:
                g_p, g_u = -2 * up, down
            else:
                g_p, g_u = up, -down
            slope = np.empty_like(w)
            slope[:-1] = p.spread(g_p, size) + u.spread(g_u, size)
            slope[-1] = g_p.sum() + g_u.sum()
            t += 1
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            w -= RATE * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
            w[:-1] *= 1 - RATE * DECAY
    return w


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> np.ndarray:
    """One row of weights a classifier; no row without any toxic text.

    The class prior is the share of toxic rows among all labels. The sample is
    bounded by ``positives`` and ``unlabelled``; which texts are taken depends on
    a hash of their id only. Rows without id, text or label teach nothing.
    """
    texts = columns(docs, doc_id=id_col, text=text_col).filter("doc_id is not null")
    marks = columns(labels, doc_id=id_col, toxic=label_col).filter(
        "doc_id is not null and toxic is not null"
    )
    confirmed, known = marks.agg(
        F.sum((F.col("toxic") == 1).cast("long")), F.count("*")
    ).first()
    if not confirmed:
        return np.empty((0, (1 << BUCKET_BITS) + 1))
    prior = float(np.clip(confirmed / known, 0.001, 0.9))
    toxic = marks.filter("toxic = 1").select("doc_id").distinct()
    taken = sample(toxic, "doc_id", positives)
    other = sample(texts.select("doc_id"), "doc_id", unlabelled).distinct()
    chosen = (
        taken.withColumn("kind", F.lit(1)).unionByName(other.withColumn("kind", F.lit(0)))
    )
    kinds = chosen.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))
    rows = semi_join(texts, kinds.select("doc_id"), "doc_id").join(kinds, "doc_id")
    lots = F.explode(F.sequence(F.lit(0), F.lit(CLASSIFIERS - 1)))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Features()
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "kinds": batch["kinds"],
                "buckets": [sorted(known.of_text(t)) for t in batch["text"]],
            })

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id")
        groups = [
            Sparse.of([np.asarray(b, np.int32) for b, k in zip(part["buckets"], part["kinds"], strict=True)
                       if kind in k])
            for kind in (1, 0)
        ]
        seed = int(part["lot"].iloc[0])
        weights = train(*groups, prior, seed).astype(np.float32)
        return pd.DataFrame({"lot": [seed], "weights": [weights.tobytes()]})

    found = rows.mapInPandas(features, "doc_id long, kinds array<int>, buckets array<int>")
    # an unlabelled text goes to one classifier, a toxic one to all
    lot = F.pmod(F.xxhash64("doc_id", F.lit("lot")), F.lit(CLASSIFIERS))
    dealt = found.select("*", lots.alias("lot")).filter(
        F.array_contains("kinds", 1) | (F.col("lot") == lot)
    ).withColumn(
        "kinds", F.when(F.col("lot") == lot, F.col("kinds")).otherwise(F.array_intersect("kinds", F.array(F.lit(1))))
    )
    fitted = dealt.groupBy("lot").applyInPandas(fit, "lot int, weights binary")
    rows = sorted(fitted.collect(), key=lambda r: r["lot"])  # one a classifier
    return np.array([np.frombuffer(r["weights"], np.float32) for r in rows])


def score(
    df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score`` for every row, from the whole text.

    The score is the mean over the classifiers of the probability of toxic
    text; a null or empty text gets the score of a text without features, and
    without classifiers all scores are 0. Repeated rows come out repeated;
    other columns are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        known = Features(set(np.flatnonzero(table[:, :-1].any(axis=0)).tolist()))
        for batch in batches:
            found = []
            for text in batch:
                used = list(known.of_text(text.as_py()))
                z = table[:, -1] + table[:, used].sum(axis=1, dtype=float)
                found.append(float(sigmoid(z).mean()) if len(table) else 0.0)
            yield pa.array(found, pa.float64())

    return columns(df, doc_id=id_col, text=text_col).select("doc_id", judge("text").alias("score"))
