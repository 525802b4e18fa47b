"""SentencePiece encoding and decoding through a table of distinct chunks.

The library marks every space and puts one mark in front of the text. No
piece of the vocabulary has a mark after another character, so merges never
cross from a word into the mark that follows it: a text falls apart into
chunks (marks, then a word) that are segmented on their own. Each task keeps
a table of the distinct chunks it has met, segments and decodes each once
with the library, and joins ids back by position. The table is bounded: a
full one is started anew.

A table for the whole corpus would need one shuffled row per word of the
corpus; the table of a task needs none and repeats little work.

Defined results: null is empty; an empty text has the begin and end ids
only. A text of any length is segmented whole. Every row is encoded on its
own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rivulet.llm.common import map_texts
from rivulet.llm.pieces import MARK, WORDS_PER_TABLE, PieceTable

_CHUNK = re.compile(" +[^ ]*")


def chunks(text: str) -> list[str]:
    """The marked words of a text, each without its first mark (which the
    library puts in front again). A mark in the text is a space to the library."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    if text[0] != " " and text[-1] != " " and "  " not in text:
        return text.split(" ")
    return [c[1:] for c in _CHUNK.findall(" " + text)]


class ChunkTable(PieceTable):
    """Distinct chunk -> its ids and its decoded text, and texts by way of it."""

    def __init__(self, model_file: str, limit: int = WORDS_PER_TABLE):
        super().__init__(model_file, limit)
        pieces = range(self.model.get_piece_size())
        if any(MARK in self.model.id_to_piece(i).lstrip(MARK) for i in pieces):
            raise ValueError("a piece of this vocabulary crosses a white space marker")
        self.begin = np.array([self.model.bos_id()], "<u4")
        self.end = np.array([self.model.eos_id()], "<u4")

    def _clear(self) -> None:
        super()._clear()
        self.text: list[str] = []

    def added(self, new: list[str], ids: list[list[int]]) -> None:
        decoded = self.model.decode(ids)
        self.text += [c if c == d else d for c, d in zip(new, decoded)]  # one copy in memory

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """For each text its ids, with begin and end, and what they decode to."""
        parts = [chunks(t) for t in texts]
        rows = self.rows([c for p in parts for c in p])
        ids, n = self.gather(rows)
        ids = ids.astype("<u4")
        after = np.append(0, np.cumsum(n))
        first = 0
        for p in parts:
            last = first + len(p)
            yield (np.concatenate([self.begin, ids[after[first]:after[last]], self.end]),
                   " ".join([self.text[r] for r in rows[first:last].tolist()]))
            first = last


def encoded(docs: DataFrame, model_file: str, text: str, id_col: str, columns: str,
            row: Callable[[np.ndarray, str], tuple]) -> DataFrame:
    """Per row of ``docs``: its id, then ``row(ids, decoded)`` as ``columns``."""
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, {columns}"

    def make():
        table = ChunkTable(model_file)

        def block(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            ids = batch.column(0)
            made = list(zip(*[row(*e) for e in table.encode(texts)]))
            return pa.RecordBatch.from_arrays(
                [ids, *[pa.array(c) for c in made]], [id_col, *names])
        return block

    names = [c.split()[0] for c in columns.split(", ")]
    return map_texts(docs.select(id_col, text), text, schema, make)


def sentence_pieces(docs: DataFrame, model_file: str, text: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: id, ``ids`` (begin, pieces, end) and ``decoded``."""
    return encoded(docs, model_file, text, id_col, "ids array<int>, decoded string",
                   lambda ids, decoded: (ids.astype("<i4"), decoded))


def sentence_piece_digests(docs: DataFrame, model_file: str, text: str = "text",
                           id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: id, ``n_tokens`` and SHA-256 of ids and decoded
    text, made beside the encoding so the ids need not leave the task."""
    return encoded(docs, model_file, text, id_col,
                   "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                   lambda ids, decoded: (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                                         hashlib.sha256(decoded.encode()).hexdigest()))
