"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word
shingles. Fingerprints at most ``distance`` bits apart are linked. The 64
bits are cut into ``distance // 2 + 1`` segments; two linked fingerprints
then agree up to a small radius in at least one of them. Each distinct
fingerprint stands in a table under its segments' values; the Hamming ball
of a segment is enumerated by clearing set bits (of two values one bit apart,
one is the other with a bit cleared), the table's matches are fetched by a
join and complete distances verified.

Copies cost nothing: only distinct fingerprints are looked up. A segment
value with more than ``MATCHES`` entries would give that many squared pairs;
its fingerprints are linked by whole balls instead. Every one of them is
sent to all values within ``ceil(distance / 2)`` bits; those that meet at a
value are linked to the smallest there, after a check of the distance that
holds by construction for even distances. That is exact, and a meeting has
at most as many members as a ball has values.

Defined results: null and empty texts have no word and fingerprint zero,
linked like any other. Rows with a null id are linked too; a group without
any id has a null component. Repeated rows and repeated ids each get their
row. Texts of any length count whole. Extra columns are ignored (or carried
as they are by ``keep_one``); an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import map_texts
from rivulet.llm.components import components
from rivulet.session import materialize

BITS = 64
HASH_SEED = 42  # fixed by the contract
MATCHES = 512  # entries of a segment value that are paired; beyond, balls
SHINGLES_AT_ONCE = 100_000


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of a text: words are split at ASCII white space, A-Z lowered."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, SHINGLES_AT_ONCE):
        part = w[start:min(n, start + SHINGLES_AT_ONCE) + shingle - 1]
        grams = zip(*[part[k:] for k in range(shingle)]) if len(w) >= shingle else [part]
        h = np.array([xxhash.xxh64_intdigest(b" ".join(g), HASH_SEED) for g in grams], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str, keep: list[str], shingle: int) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint's bits as a long)."""
    d = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{c}` {t}" for c, t in d.dtypes if c != "__text"] + ["fp bigint"])

    def make():
        def block(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)],
                                              [*batch.schema.names[:-1], "fp"])
        return block

    return map_texts(d, "__text", schema, make)


def _segments(distance: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment: with ``distance = m a + b``, one
    of the first ``b + 1`` is within ``a`` bits or one of the rest within ``a - 1``."""
    m = distance // 2 + 1
    a, b = divmod(distance, m)
    edges = [BITS * k // m for k in range(m + 1)]
    return [(lo, hi - lo, a if k <= b else a - 1) for k, (lo, hi) in
            enumerate(zip(edges, edges[1:]))]


def _segment_keys(seg: int, shift: int, width: int, radius: int) -> Column:
    mask = F.lit((1 << width) - 1 if width < BITS else -1).cast("long")
    value = F.shiftrightunsigned("fp", shift).bitwiseAND(mask)

    def key(v: Column, entry: bool) -> Column:
        return F.struct(F.lit(seg).alias("seg"), v.alias("key"), F.lit(entry).alias("entry"))

    def cleared(i: Column) -> Column:
        return key(value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)), False)

    entry = F.array(key(value, True))
    if radius == 0:
        return entry
    ones = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.getbit(value, i) == 1)
    return F.concat(entry, F.transform(ones, cleared))


def _keys(distance: int) -> Column:
    """The table entries and the probes of a fingerprint, as (seg, key, entry)."""
    return F.concat(*[_segment_keys(seg, *s) for seg, s in enumerate(_segments(distance))
                      if s[2] >= 0])


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _ball(distance: int) -> Column:
    """All values within ``ceil(distance / 2)`` bits of ``fp``."""
    flips = [0]
    for k in range(1, (distance + 1) // 2 + 1):
        flips += [sum(1 << i for i in at) for at in combinations(range(BITS), k)]
    signed = np.array(flips, np.uint64).view(np.int64).tolist()
    return F.transform(F.array(*[F.lit(f).cast("long") for f in signed]),
                       lambda x: F.col("fp").bitwiseXOR(x))


def links(fps: DataFrame, distance: int, matches: int = MATCHES) -> DataFrame:
    """Edges (u, v), u < v, between distinct fingerprints ``fp``, whose
    components are those of all pairs within ``distance`` bits."""
    keyed = fps.select("fp", F.explode(_keys(distance)).alias("k")).select("fp", "k.*")
    load = (keyed.groupBy("seg", "key")
            .agg(F.count_if("entry").alias("entries"), F.count(F.lit(1)).alias("n"))
            .filter("entries > 0 AND n > 1")
            .select("seg", "key", (F.col("n") > matches).alias("heavy")))
    met = materialize(keyed.join(load, ["seg", "key"]))
    bucket = (met.filter(~F.col("heavy")).groupBy("seg", "key")
              .agg(F.collect_list("fp").alias("all"),
                   F.collect_list(F.when(F.col("entry"), F.col("fp"))).alias("entries"))
              .select("all", F.explode("entries").alias("fp")))
    near = F.filter("all", lambda x: (x != F.col("fp")) & (_distance(x, F.col("fp")) <= distance))
    pairs = bucket.select("fp", F.explode(near).alias("other"))
    meeting = (met.filter("heavy").select("fp").distinct()
               .select("fp", F.explode(_ball(distance)).alias("at"))
               .groupBy("at").agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1))
    if distance % 2 == 0:  # two values this near to a third are within the distance
        stars = meeting.select(F.explode("all").alias("fp"), F.array_min("all").alias("other"))
        stars = stars.filter("fp != other")
    else:
        stars = meeting.select("all", F.explode("all").alias("fp")).select(
            "fp", F.explode(near).alias("other"))
    return (pairs.unionByName(stars)
            .select(F.least("fp", "other").alias("u"), F.greatest("fp", "other").alias("v"))
            .distinct())


def _grouped(rows: DataFrame, distance: int, name: Column) -> DataFrame:
    """(fp, root, first) per distinct fingerprint: its component and the
    smallest ``name`` in it."""
    fps = materialize(rows.groupBy("fp").agg(F.min(name).alias("first")))
    roots = components(links(fps.select("fp"), distance))
    rooted = (fps.join(roots, fps["fp"] == roots["node"], "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = (rooted.join(roots.select("node"), rooted["fp"] == roots["node"], "left_semi")
             .groupBy("root").agg(F.min("first").alias("least")))
    # By a key of its own shape: both sides come from an exchange, and a
    # component that holds much of the table is split.
    return (rooted.withColumn("of", F.struct("root"))
            .join(least.select(F.struct("root").alias("of"), "least"), "of", "left")
            .select("fp", "root", F.coalesce("least", "first").alias("first")))


def simhash_groups(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                   shingle: int = 3, distance: int = 2) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (16 hex digits) and
    ``component_id`` (smallest id reachable by links)."""
    rows = materialize(fingerprints(docs, text, [id_col], shingle))
    groups = _grouped(rows, distance, F.col(id_col))
    return rows.join(groups, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3,
             distance: int = 2) -> DataFrame:
    """The rows of ``docs``, all their columns, one for each group: the one
    of the smallest id (a null id counts as largest; ties by content)."""
    digest = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                         F.col(id_col).alias("id"), digest.alias("digest"),
                         F.col(text).alias("t"))
    rows = materialize(fingerprints(tagged, "t", ["id", "digest"], shingle))
    name = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"),
                    F.col("digest").alias("digest"))
    # Every fingerprint of a group has its first row; that of the root names it once.
    first = _grouped(rows, distance, name).filter("fp = root").select("first.id", "first.digest")
    same = (tagged["id"].eqNullSafe(first["id"])) & (tagged["digest"] == first["digest"])
    kept = tagged.drop("t").join(first, same, "left_semi")
    one = Window.partitionBy("id", "digest").orderBy("digest")
    return (kept.withColumn("n", F.row_number().over(one)).filter("n = 1").select("__row.*"))
