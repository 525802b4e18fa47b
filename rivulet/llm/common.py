"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed by the contracts: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

CHARS_PER_BLOCK = 4_000_000  # text decoded at once in a Python worker


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a non-null text."""
    return F.array_remove(F.split(text, SPACES), "")


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column | str, modulus: int, held: int) -> Column:
    """True for the held-out fold; a null id is never held out."""
    return F.coalesce(remainder(doc_id, modulus) == held, F.lit(False))


def sample_by_hash(df: DataFrame, key: Column, share: Column | float, limit: int) -> DataFrame:
    """About ``share`` of the rows, the same ones at every run: those whose
    hashed ``key`` falls in the first ``share`` of the hash range; never more
    than ``limit`` rows, those of the smallest hashes of key, then row, however
    often a key repeats."""
    hashed = F.xxhash64(key)
    row = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    return (df.filter(hashed.cast("double") / 2.0 ** 64 + 0.5 < share)
            .orderBy(hashed, row).limit(limit))


def blocks(batches: Iterator[pa.RecordBatch], text: str,
           chars: int = CHARS_PER_BLOCK) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into blocks of at most ``chars`` characters of text
    (a longer text is a block of its own), so a worker's memory does not
    depend on the lengths of 10,000 texts. Yields (batch slice, its texts;
    null as empty)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start, held, texts = 0, 0, []
        for i in range(batch.num_rows):
            t = column[i].as_py() or ""
            if texts and held + len(t) > chars:
                yield batch.slice(start, len(texts)), texts
                start, held, texts = i, 0, []
            texts.append(t)
            held += len(t)
        if texts:
            yield batch.slice(start, len(texts)), texts


def map_texts(df: DataFrame, text: str, schema: str,
              make: Callable[[], Callable[[pa.RecordBatch, list[str]], pa.RecordBatch | None]],
              chars: int = CHARS_PER_BLOCK) -> DataFrame:
    """``mapInArrow`` over bounded blocks of texts. ``make`` runs once per
    task and returns the function of a block (its model and caches live as
    long as the task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for block, texts in blocks(batches, text, chars):
            out = of(block, texts)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def filter_texts(df: DataFrame, text: str,
                 make: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """Rows of ``df``, all columns, whose text the function of a block keeps."""

    def rows() -> Callable[[pa.RecordBatch, list[str]], pa.RecordBatch]:
        keep = make()
        return lambda block, texts: block.filter(pa.array(keep(texts), pa.bool_()))

    return map_texts(df, text, df.schema, rows)
