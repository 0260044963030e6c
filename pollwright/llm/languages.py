"""Language identification as inference of a mixture of languages.

Every language has a distribution over hashed character trigrams, counted over
all training texts. A document is a mixture of languages: expectation
maximisation estimates the proportions, and the set of languages is the one
whose likelihood, less a penalty per language, is highest. Sets grow one
language at a time from the best single one; where even all languages together
gain less than the penalty, no set can win and the search ends at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.llm.common import columns

UNKNOWN = "und"
BUCKET_BITS = 16
#: A model keeps 256 KB a language; more languages are refused, not dropped.
MAX_LANGUAGES = 512
#: Vectors of counts that a task keeps before it passes them on.
HELD_LANGUAGES = 32
SMOOTHING = 0.5
STEPS = 12
#: Log likelihood that a further language has to add, per log of the trigrams.
PENALTY = 6.0


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(text: str, letters: np.ndarray) -> np.ndarray:
    """Hashed trigrams of the lower-case letters; what lies between them counts as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters[codes]
    if not is_letter.any():
        return np.empty(0, np.uint16)
    after = np.concatenate([[False], is_letter[:-1]])
    kept = is_letter | after
    codes = np.where(is_letter, codes, 32)[kept].astype(np.uint32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    mixed = (
        codes[:-2] * np.uint32(0x9E3779B1)
        + codes[1:-1] * np.uint32(0x85EBCA77)
        + codes[2:] * np.uint32(0xC2B2AE3D)
    )
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.uint16)


@dataclass
class Model:
    languages: list[str]
    #: log P(bucket | language), one row a bucket
    log_p: np.ndarray


def learn(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """Count trigrams of every text with a language.

    Tasks add up whole vectors and pass on their non-zero counts, so what is
    shuffled is bounded by buckets and not by texts, and a language with most
    of the rows costs no more than another.
    """
    rows = columns(df, text=text_col, lang=lang_col).filter("lang is not null and text is not null")
    session = df.sparkSession
    letters = session.sparkContext.broadcast(letter_table())
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()),
                     pa.array(counts[used], pa.int64())],
                    ["lang", "bucket", "n"],
                )
            held.clear()

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                lang = lang.as_py()
                if lang not in held:
                    if len(held) == HELD_LANGUAGES:
                        yield from passed()
                    held[lang] = np.zeros(size, np.int64)
                held[lang] += np.bincount(trigrams(text.as_py(), letters.value), minlength=size)
        yield from passed()

    parts = rows.mapInArrow(count, "lang string, bucket int, n long")
    total = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = [r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages.sort()
    counted = total.toPandas()  # at most a row for each language and bucket
    counts = np.full((size, len(languages)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(languages)}
    counts[counted["bucket"].to_numpy(), counted["lang"].map(place).to_numpy(dtype=int)] += (
        counted["n"].to_numpy()
    )
    return Model(languages, np.log(counts / counts.sum(axis=0)))


def mixture(p: np.ndarray, n: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``p`` by expectation maximisation, and the log likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    total = n.sum()
    for _ in range(steps):
        share = share * ((n / (p @ share)) @ p) / total
    return share, float(n @ np.log(p @ share))


def infer(p: np.ndarray, log_p: np.ndarray, n: np.ndarray) -> tuple[dict[int, float], float]:
    """Language set with proportions, and how much of the text its main language holds.

    ``p`` and ``log_p`` have a row for each distinct trigram of the text and
    ``n`` counts them.
    """
    single = n @ log_p
    best = int(np.argmax(single))
    share, whole = mixture(p, n)
    cost = PENALTY * np.log(n.sum() + 1)
    if whole - single[best] <= cost:
        return {best: 1.0}, float(share[best])
    chosen, worth, kept = [best], float(single[best]), np.ones(1)
    while len(chosen) < p.shape[1]:
        tried = []
        for other in range(p.shape[1]):
            if other not in chosen:
                parts, likelihood = mixture(p[:, [*chosen, other]], n)
                tried.append((likelihood, -other, parts))
        likelihood, other, parts = max(tried, key=lambda x: x[:2])
        if likelihood - worth <= cost:
            break
        chosen, worth, kept = [*chosen, -other], likelihood, parts
    return {c: float(k) for c, k in zip(chosen, kept, strict=True)}, float(kept.max())


def predictor(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function from a text column to a struct of ``lang_pred, score, languages``."""
    letters = spark.sparkContext.broadcast(letter_table())
    tables = spark.sparkContext.broadcast((model.log_p, np.exp(model.log_p)))
    names = model.languages
    kind = "struct<lang_pred:string,score:double,languages:array<struct<lang:string,share:double>>>"

    @F.arrow_udf(kind)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        log_p, p = tables.value
        for batch in batches:
            out = []
            for text in batch:
                grams = trigrams(text.as_py() or "", letters.value)
                if not len(grams) or not names:
                    out.append({"lang_pred": UNKNOWN, "score": 0.0, "languages": []})
                    continue
                used, n = np.unique(grams, return_counts=True)
                found, score = infer(p[used], log_p[used], n.astype(float))
                parts = sorted(((names[k], v) for k, v in found.items()), key=lambda x: (-x[1], x[0]))
                out.append({
                    "lang_pred": parts[0][0], "score": min(1.0, max(0.0, score)),
                    "languages": [{"lang": a, "share": b} for a, b in parts],
                })
            yield pa.array(out, pa.struct([
                ("lang_pred", pa.string()), ("score", pa.float64()),
                ("languages", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
            ]))

    return predict


def identify(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score, languages`` for every row.

    ``languages`` lists the chosen languages with their proportions, largest
    first (ties by name), and ``score`` is the part of the text that is the
    first one's. A null text, one without letters, or a model without
    languages gives ``und`` with score 0 and no languages. Repeated rows come
    out repeated; other columns are left out.
    """
    predict = predictor(df.sparkSession, model)
    found = columns(df, doc_id=id_col, text=text_col).select("doc_id", predict("text").alias("_f"))
    return found.select("doc_id", "_f.lang_pred", "_f.score", "_f.languages")
