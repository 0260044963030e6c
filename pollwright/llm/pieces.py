"""SentencePiece encoding and decoding by a table of distinct chunks.

Where no piece has a whitespace marker behind another character, merges never
cross the start of a marked word. A text is then cut into marked words, every
distinct one is segmented once into a table, and the ids of a text are the
table's entries taken by position. The table belongs to a task: it needs no
shuffle of word positions, which would be many times the size of the texts,
and it is emptied when it reaches ``TABLE_CHUNKS`` entries, so memory is
bounded while every text is encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pollwright.llm.common import columns, slices

MARK = "▁"
#: Entries of a task's chunk table, characters of an entry.
TABLE_CHUNKS = 50_000
ENTRY_CHARS = 64


def load(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def check_model(processor) -> None:
    """Raise where marked words can't be segmented alone."""
    if any(MARK in processor.id_to_piece(i).lstrip(MARK) for i in range(processor.vocab_size())):
        raise ValueError("the model has pieces with an inner whitespace marker")
    if processor.encode(" a  b") != processor.encode(f"{MARK}a{MARK}{MARK}b"):
        raise ValueError("the model changes white space")
    if processor.id_to_piece(processor.encode("a"))[0][:1] != MARK:
        raise ValueError("the model adds no marker in front of a text")


class ChunkTable:
    """Ids of each distinct marked word, and the ids of texts taken from them by position."""

    def __init__(self, processor) -> None:
        self.processor, self.find = processor, re.compile(f"{MARK}+[^{MARK}]*").findall
        self.known: dict[str, list[int]] = {}
        self.alone = [processor.piece_to_id(MARK)]

    def segment(self, chunks: list[str]) -> None:
        # encode() puts the first marker back
        found = self.processor.encode([c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
        self.known.update(zip(chunks, found, strict=True))
        if MARK in self.known:
            self.known[MARK] = self.alone

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        marked = [self.find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        here = set().union(*marked)
        new = [c for c in here if c not in self.known]
        self.segment(new)
        row = {c: i for i, c in enumerate(here)}
        entries = [self.known[c] for c in row]
        length = np.fromiter(map(len, entries), np.int64, len(entries))
        start = np.cumsum(length) - length
        flat = np.fromiter(chain.from_iterable(entries), np.int32, int(length.sum()))
        found = []
        for chunks in marked:
            rows = np.fromiter(map(row.__getitem__, chunks), np.int64, len(chunks))
            n = length[rows]
            ends = np.cumsum(n)
            within = np.arange(ends[-1] if len(ends) else 0)
            found.append(flat[within + np.repeat(start[rows] - ends + n, n)])
        for chunk in new:
            if len(chunk) > ENTRY_CHARS:
                del self.known[chunk]
        if len(self.known) > TABLE_CHUNKS:
            self.known.clear()
        return found


def lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


class PieceTable:
    """Texts of ids: the bytes of each piece, joined."""

    def __init__(self, processor) -> None:
        self.processor = processor
        self.pieces = [self.piece(i) for i in range(processor.vocab_size())]
        self.plain = [
            not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i))
            for i in range(processor.vocab_size())
        ]

    def piece(self, i: int) -> bytes:
        text = self.processor.id_to_piece(i)
        if self.processor.is_byte(i):
            return bytes([int(text[3:5], 16)])
        return text.replace(MARK, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """Unusual ids, and bytes that aren't UTF-8, are left to the library."""
        if not ids:
            return ""
        try:
            if not all(map(self.plain.__getitem__, ids)):
                return self.processor.decode(ids)
            text = b"".join(map(self.pieces.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            return self.processor.decode(ids)
        first = self.pieces[ids[0]]
        return text[1:] if first[:1] == b" " and not self.processor.is_byte(ids[0]) else text


def kind_of(rows: DataFrame) -> str:
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"


def round_trip(
    df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", back: bool = True
) -> DataFrame:
    """``doc_id, ids, decoded``: both directions in one pass; without ``back`` the ids only."""
    check_model(load(model))
    rows = columns(df, doc_id=id_col, text=text_col)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = load(model)
        chunks, table = ChunkTable(processor), PieceTable(processor)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = chunks.encode([t or "" for t in part["text"].to_pylist()])
                found, names = [part["doc_id"], lists(ids)], ["doc_id", "ids"]
                if back:
                    found.append(pa.array([table.decode(x.tolist()) for x in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(found, names)

    more = ", decoded string" if back else ""
    return rows.mapInArrow(read, f"{kind_of(rows)}, ids array<int>{more}")


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row, as the library's ``encode(text)``; null and empty: no ids.

    Repeated rows come out repeated, an empty table gives no rows, and other
    columns are left out, so none can clash.
    """
    return round_trip(df, model, id_col, text_col, back=False)


def decode(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` for every row, as the library's ``decode(ids)``; null and no ids: empty."""
    rows = columns(df, doc_id=id_col, ids=ids_col)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(load(model))
        for batch in batches:
            texts = [table.decode(x.as_py() or []) for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return rows.mapInArrow(read, f"{kind_of(rows)}, text string")
