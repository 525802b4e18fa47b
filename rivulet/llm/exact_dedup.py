"""Exact duplicates by deterministic block naming.

A text is cut into blocks of ``BLOCK`` bytes. All different blocks of the
corpus are sorted and numbered: a block's number is its name. Then, level by
level, the pairs of adjacent names are sorted and numbered in turn, which
halves every document, until one name is left of it. Two documents have one
name if and only if they have the same bytes: nothing is decided by a hash.

Occurrences find their block's name through a lookup key, hashes of the
block, so the bytes of a block are shuffled once only (different ones, after
a combine in each task). That the key tells all blocks of the corpus apart is
checked by counts; where it does not, a hash is added to it and the blocks
are named anew. A pair of names is its own key. Names are numbered in sorted
partitions and written down before they are used, so a lost executor cannot
change one. Name lookups and the join of documents to their group read two
exchanges, so a block, or a text, that a third of all rows hold is split by
Spark's rule for skewed joins.

Defined results: null counts as empty; texts are compared after each run of
ASCII white space is made one space, so a text of white space only equals one
space, not the empty text. Of equal texts the row of the smallest id stays; a
null id counts as largest, and of repeated rows exactly one stays. Texts of
any length are compared whole. Extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import SPACES, text_or_empty
from rivulet.session import materialize

BLOCK = 1024  # bytes
KEY_HASHES = 2  # 64-bit hashes of a block's lookup key at first
HASH_BITS = 64
LEVEL_BITS = 6  # of a name: the level it belongs to


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _normalised(text: str) -> Column:
    return F.regexp_replace(text_or_empty(text), SPACES, " ").cast("binary")


def _blocks(data: Column, size: int, of: Callable[[Column], Column]) -> Column:
    """``of`` each block of ``data``; an empty text is one empty block."""
    last = F.greatest(F.ceil(F.octet_length(data) / size), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last.cast("int")),
                       lambda i: of(F.substring(data, i * size + 1, F.lit(size))))


def _key(block: Column, hashes: int, bits: int) -> Column:
    mask = F.lit((1 << bits) - 1 if bits < 64 else -1).cast("long")
    return F.struct(*[F.xxhash64(F.lit(seed), block).bitwiseAND(mask).alias(f"h{seed}")
                      for seed in range(hashes)])


def _numbered(distinct: DataFrame, order: list[str], key: Column, level: int) -> DataFrame:
    """(key, name): the rows of ``distinct``, sorted within their partitions
    and numbered, with the level in the last bits. The key is a new struct, so
    a join by it has an exchange of its own on this side."""
    number = F.monotonically_increasing_id() * (1 << LEVEL_BITS) + level
    return materialize(distinct.sortWithinPartitions(*order)
                       .select(key.alias("key"), number.alias("name")))


def _block_names(docs: DataFrame, text: str, size: int, bits: int) -> tuple[DataFrame, int]:
    """(key, name) of every different block, and the hashes a key needs so
    that no two blocks share one."""
    hashes = KEY_HASHES
    while True:
        blocks = docs.select(F.explode(_let(_normalised(text), lambda t: _blocks(
            t, size, lambda b: b))).alias("block"))
        names = _numbered(blocks.distinct(), ["block"], _key(F.col("block"), hashes, bits), 0)
        if names.groupBy("key").count().filter("count > 1").isEmpty():
            return names, hashes
        hashes += 1


def identities(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(row, identity) from ``rows`` (row, keys of its blocks) and the names of
    the blocks."""
    longest = rows.agg(F.max(F.size("keys"))).first()[0] or 0
    at = rows.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
    named = at.join(names, "key").select("row", "n", "pos", "name")
    done, level = [], 0
    while True:
        last = longest <= 1
        # A row with one name left is ready; the last level has no others.
        named = named if last else materialize(named)
        done.append(named.filter("n = 1").select("row", F.col("name").alias("identity")))
        if last:
            return reduce(DataFrame.unionByName, done)
        level, longest = level + 1, -(-longest // 2)

        def side(odd: int) -> Column:
            return F.coalesce(F.max(F.when(F.col("pos") % 2 == odd, F.col("name"))), F.lit(-1))

        pairs = materialize(
            named.filter("n > 1").groupBy("row", "n", F.shiftright("pos", 1).alias("half"))
            .agg(side(0).alias("a"), side(1).alias("b")))  # -1: no name, the odd one at the end
        known = _numbered(pairs.select("a", "b").distinct(), ["a", "b"], F.struct("a", "b"), level)
        named = (pairs.withColumn("key", F.struct("a", "b")).join(known, "key")
                 .select("row", F.ceil(F.col("n") / 2).cast("int").alias("n"),
                         F.col("half").alias("pos"), "name"))


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", block: int = BLOCK,
                hash_bits: int = HASH_BITS) -> DataFrame:
    """Per row of ``docs``: id, ``keep_id`` (id of the row that stays),
    ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text).

    ``hash_bits`` narrows the hashes of lookup keys, for tests."""
    names, hashes = _block_names(docs, text, block, hash_bits)
    read = _let(_normalised(text), lambda t: F.struct(
        F.sha2(t, 256).alias("sha"),
        _blocks(t, block, lambda b: _key(b, hashes, hash_bits)).alias("keys")))
    rows = materialize(docs.select(F.col(id_col).alias("id"), read.alias("r"))
                       .select(F.monotonically_increasing_id().alias("row"), "id", "r.*"))
    grouped = materialize(rows.select("row", "id", "sha")
                          .join(identities(rows.select("row", "keys"), names), "row"))
    first = F.min(F.struct(F.col("id").isNull(), F.col("id").alias("id"), "row"))
    groups = materialize(grouped.groupBy("identity").agg(
        first.alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select(F.struct("identity").alias("key"), "first.id", "first.row", "group_size"))
    g, d = groups.alias("g"), grouped.withColumn("key", F.struct("identity")).alias("d")
    return d.join(g, "key").select(
        F.col("d.id").alias(id_col), F.col("g.id").alias("keep_id"), "g.group_size",
        (F.col("d.row") == F.col("g.row")).alias("kept"), F.col("d.sha").alias("text_sha256"))


def dedup_sql() -> str:
    """DuckDB SQL of ``exact_dedup`` over ``documents``."""
    return r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents),
n AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
      row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM n"""
