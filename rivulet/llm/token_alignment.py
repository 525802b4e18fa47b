"""Alignment of two tokenizers over a corpus, each distinct text once.

Rows are shuffled by full text and counted; each distinct text is tokenised
and aligned once, weighted by its number of rows, and its measures are joined
back to the documents. The join is by SHA-256 of the text, so the texts
themselves cross the network once (after a combine in each task).

Both tokenizers end a token before a space that follows a character other than
white space. Texts are cut there into chunks; a task keeps a table of the
distinct chunks it has met, with the chunk's ids, groups and links, and a text
is put together from its chunks by position. The table is bounded in chunks and
characters; a full one is started anew.

A pair's count is summed in Spark, combined in each task first. The counts are
joined to the pairs of each text by broadcast if they are few, which is
checked, and else by a shuffle.

Defined results: texts that are null, empty, or that the joined tokens do not
give back have no tokens: all numbers are 0 and the digest is empty. Texts of
any length count whole. Repeated rows and repeated or null ids each get their
row and count as documents of their own. Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import map_texts
from rivulet.llm.pieces import MARK
from rivulet.session import materialize, scratch_path

CHUNKS_PER_TABLE = 250_000
CHARS_PER_TABLE = 6_000_000  # of the chunks; links are bounded alike
CHUNKS_AT_ONCE = 20_000
CHARS_AT_ONCE = 1_000_000
BROADCAST_PAIRS = 2_000_000  # pair counts that are broadcast; beyond, a shuffle
_CUT = re.compile(r"(?<=\S) ")
_AFTER_WHITE = re.compile(r"\s ")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def chunks(text: str) -> list[str]:
    """A space and ``text``, cut before each space that follows a character
    other than white space; the chunks' first spaces are left out."""
    text = " " + text
    if _AFTER_WHITE.search(text) is None:
        return text[1:].split(" ")
    cuts = [0, *[m.start() for m in _CUT.finditer(text)], len(text)]
    return [text[a + 1:b] for a, b in zip(cuts, cuts[1:])]


def byte_level() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes_a(tokenizer: tokenizers.Tokenizer) -> list[bytes]:
    """The bytes of each id (none for special ones, which texts never get)."""
    of = byte_level()
    out = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab(False).items():
        out[i] = bytes(of[c] for c in token) if of.keys() >= set(token) else b""
    return out


def token_bytes_b(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = _BYTE_PIECE.fullmatch(piece) if model.is_byte(i) else None
        out.append(bytes([int(byte[1], 16)]) if byte else piece.replace(MARK, " ").encode())
    return out


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each start, as many as its count."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


class AlignmentTable:
    """Distinct chunk -> its groups and links, worked out once."""

    def __init__(self, byte_bpe_file: str, piece_model: str, most_chunks: int = CHUNKS_PER_TABLE,
                 most_chars: int = CHARS_PER_TABLE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = tokenizers.Tokenizer.from_file(byte_bpe_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        if any(MARK in self.b.id_to_piece(i).lstrip(MARK) for i in range(self.b.get_piece_size())):
            raise ValueError("a piece of this vocabulary crosses a white space marker")
        self.bytes_a, self.bytes_b = token_bytes_a(self.a), token_bytes_b(self.b)
        self.wide_a, self.wide_b = (np.array([len(x) for x in table], np.int64)
                                    for table in (self.bytes_a, self.bytes_b))
        # A token as it is shown: followed by another one of its group or not.
        self.marks = [f"{i}{sep}" for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;"))
                      for sep in ends for i in range(n)]
        self.most_chunks, self.most_chars = most_chunks, most_chars
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.chars = self.used = 0
        self.shown: list[str | None] = []  # the groups as text; None: the bytes differ
        self.numbers = np.zeros((1 << 10, len(NUMBERS)), np.int32)
        self.start = np.zeros(1 << 10, np.int64)
        self.flat = np.zeros(1 << 12, np.int64)  # linked pairs, a * 2^32 + b

    def rows(self, parts: list[str]) -> np.ndarray:
        if len(self.row) > self.most_chunks or max(self.chars, self.used) > self.most_chars:
            self._clear()
        at = np.fromiter(map(self.row.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            lacked = [parts[i] for i in missing]
            new = list(dict.fromkeys(lacked))
            # One call for many chunks, but for those that a following space
            # would not be cut from.
            odd = [c for c in new if not c or c[-1].isspace()]
            plain = [c for c in new if c and not c[-1].isspace()] if odd else new
            for some, encode in ((plain, self._together), (odd, self._apart)):
                for k in range(0, len(some), CHUNKS_AT_ONCE):
                    part = some[k:k + CHUNKS_AT_ONCE]
                    self._add(part, *(encode(part) or self._apart(part)))
            at[missing] = [self.row[c] for c in lacked]
        return at

    def _together(self, new: list[str]) -> tuple | None:
        """Both tokenizers' ids of all chunks, how many are each chunk's, and
        which chunks they give back; None if not all are given back."""
        text = " " + " ".join(new)
        data = text.encode()
        ids_a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        ids_b = self.b.encode(new, num_threads=1)
        b, n_b = self._flat(ids_b)
        for ids, table in ((ids_a, self.bytes_a), (b.tolist(), self.bytes_b)):
            if b"".join(map(table.__getitem__, ids)) != data:
                return None
        a = np.array(ids_a, np.int64)
        ends = np.cumsum(np.bincount(np.repeat(np.arange(len(new)), n_b), self.wide_b[b]))
        n_a = np.diff(np.searchsorted(np.cumsum(self.wide_a[a]), ends, "right"), prepend=0)
        return a, n_a, b, n_b, np.ones(len(new), bool)

    def _apart(self, new: list[str]) -> tuple:
        """The same chunk by chunk; one that is not given back has no ids."""
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in new], add_special_tokens=False)]
        ids_b = self.b.encode(new, num_threads=1)  # the library marks the first space
        if "" in new:  # a space alone, of which it would see an empty text
            ids_b[new.index("")] = [self.b.piece_to_id(MARK)]
        good = np.ones(len(new), bool)
        for k, c in enumerate(new):
            own = (" " + c).encode()
            if any(b"".join(map(table.__getitem__, ids[k])) != own
                   for table, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))):
                good[k], ids_a[k], ids_b[k] = False, [], []
        return *self._flat(ids_a), *self._flat(ids_b), good

    @staticmethod
    def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n

    def _add(self, new: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray,
             good: np.ndarray) -> None:
        # Ends in all chunks' bytes; each chunk's last byte is an end of both.
        end_a, end_b = np.cumsum(self.wide_a[a]), np.cumsum(self.wide_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        in_a, in_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
        first_b = np.cumsum(in_b) - in_b
        times = in_b[group_a]
        pairs = np.repeat(a << 32, times) | b[_spread(first_b[group_a], times)]

        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        of_chunk = np.searchsorted(last_a, np.cumsum(in_a))  # the chunk a group is in
        links = np.bincount(of_chunk, in_a * in_b, len(new)).astype(np.int64)
        # A group is shown as its tokens of one side, then those of the other.
        sep_a = np.diff(group_a, append=len(common)) > 0
        sep_b = np.diff(group_b, append=len(common)) > 0
        place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
        marks = np.empty(len(a) + len(b), np.int64)
        marks[place_a] = a + sep_a * len(self.bytes_a)
        marks[place_b] = b + sep_b * len(self.bytes_b) + 2 * len(self.bytes_a)
        shown = list(map(self.marks.__getitem__, marks.tolist()))
        to = (last_a + last_b).tolist()
        texts = ["".join(shown[i:j]) for i, j in zip([0, *to], to)]

        first = len(self.shown)
        last = first + len(new)
        self.row.update(zip(new, range(first, last)))
        self.shown += texts if good.all() else [t if ok else None for t, ok in zip(texts, good)]
        self.numbers, self.start = (self._room(x, last) for x in (self.numbers, self.start))
        groups = np.bincount(of_chunk, minlength=len(new))
        self.numbers[first:last] = np.stack([n_a, n_b, groups, links], axis=1)
        self.start[first:last] = self.used + np.cumsum(links) - links
        self.flat = self._room(self.flat, self.used + len(pairs))
        self.flat[self.used:self.used + len(pairs)] = pairs
        self.used += len(pairs)
        self.chars += sum(map(len, new))

    @staticmethod
    def _room(x: np.ndarray, size: int) -> np.ndarray:
        return x if size <= len(x) else np.concatenate(
            [x, np.zeros((max(size - len(x), len(x) // 2), *x.shape[1:]), x.dtype)])

    def texts(self, texts: list[str]) -> list[tuple]:
        """For each text (n_a, n_b, n_groups, n_links), the digest of its groups,
        and its linked pairs with how often each is linked."""
        out, start, held = [], 0, 0
        for k, t in enumerate(texts):  # some at a time: a chunk is an object of its own
            held += len(t)
            if held > CHARS_AT_ONCE or k == len(texts) - 1:
                out += self._texts(texts[start:k + 1])
                start, held = k + 1, 0
        return out

    def _texts(self, texts: list[str]) -> list[tuple]:
        none = np.zeros(0, np.int64)
        parts = [chunks(t) for t in texts]
        rows = self.rows([c for p in parts for c in p])
        out, first = [], 0
        for p, text in zip(parts, texts):
            own = rows[first:first + len(p)]
            first += len(p)
            shown = [self.shown[r] for r in own.tolist()]
            if not text or None in shown:
                out.append(((0,) * len(NUMBERS), "", none, none))
                continue
            numbers = self.numbers[own].astype(np.int64)
            at = _spread(self.start[own], numbers[:, 3])
            out.append((tuple(numbers.sum(axis=0).tolist()),
                        hashlib.sha256("".join(shown)[:-1].encode()).hexdigest(),
                        *np.unique(self.flat[at], return_counts=True)))
        return out


PAIRS = "array<struct<a:int,b:int,links:int>>"


def aligned_texts(texts: DataFrame, byte_bpe_file: str, piece_model: str) -> DataFrame:
    """(key, rows, the numbers, groups_sha256, pairs) from (key, rows, text)."""
    schema = ", ".join(["key string", "rows bigint", *[f"{n} bigint" for n in NUMBERS],
                        "groups_sha256 string", f"pairs {PAIRS}"])

    def make():
        table = AlignmentTable(byte_bpe_file, piece_model)

        def block(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            numbers, digests, pairs, links = zip(*table.texts(texts))
            pair = np.concatenate(pairs)
            ends = np.cumsum([0, *map(len, pairs)])
            each = pa.StructArray.from_arrays(
                [pa.array((pair >> 32).astype(np.int32)), pa.array(pair.astype(np.int32)),
                 pa.array(np.concatenate(links).astype(np.int32))], ["a", "b", "links"])
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *[pa.array(x, pa.int64()) for x in zip(*numbers)],
                 pa.array(digests), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)],
                ["key", "rows", *NUMBERS, "groups_sha256", "pairs"])
        return block

    return map_texts(texts.select("key", "rows", "text"), "text", schema, make)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, count, best): rows of the corpus that hold a pair linked; whether
    no pair of its ``a`` has more. A window holds one id's pairs, at most one
    for each id of the other vocabulary."""
    counts = (aligned.select("rows", F.inline("pairs")).groupBy("a", "b")
              .agg(F.sum("rows").alias("count")))
    most = F.max("count").over(Window.partitionBy("a"))
    return counts.withColumn("best", F.col("count") == most)


def token_alignment(docs: DataFrame, byte_bpe_file: str, piece_model: str, text: str = "text",
                    id_col: str = "doc_id", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs``: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum`` and ``groups_sha256``."""
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    key = F.when(F.col("text") != "", F.sha2("text", 256))
    texts = (given.filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("rows"))
             .withColumn("key", key))
    path = scratch_path(spark, "aligned")
    aligned_texts(texts, byte_bpe_file, piece_model).write.parquet(path)
    aligned = spark.read.parquet(path)

    counts = materialize(pair_counts(aligned))
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    sums = (aligned.select("key", F.inline("pairs")).join(counts, ["a", "b"]).groupBy("key")
            .agg(F.sum(F.when(F.col("best"), F.col("links"))).alias("n_best"),
                 F.sum(F.col("links") * F.col("count")).alias("count_sum")))
    measures = ["n_best", "count_sum"]
    # One row per text under a key of its own shape: the join with the
    # documents then reads two exchanges, and a hot text is split.
    per_text = materialize(aligned.drop("pairs", "rows").join(sums, "key", "left")
                           .select(F.struct("key").alias("of"), *NUMBERS, *measures, "groups_sha256"))
    of = F.when(key.isNotNull(), F.struct(key.alias("key")))
    return (given.select("id", of.alias("of")).join(per_text, "of", "left")
            .select(F.col("id").alias(id_col),
                    *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in (*NUMBERS, *measures)],
                    F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))
