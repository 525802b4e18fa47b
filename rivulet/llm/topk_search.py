"""Exact top-k search over binary codes by incremental multi-index hashing.

The code of a vector is the signs of its components, in words of 64. Every code stands in a
table under the value of each of its ``m`` segments. For all queries together
the search radius grows: round r probes, in each segment, the values exactly
r bits away (the first round: up to r) and verifies whole distances of what
it fetches.
After round r every code within ``m (r + 1) - 1`` bits has been met, so a
query is done once its k-th verified neighbour lies within that.

Only distinct codes are probed and fetched; a code carries its ``k + 1``
smallest ids (one may be the query itself), so a vector that fills a third
of the table costs as much as any other. Rounds are cut off by reliable
checkpoints.

Defined results: neighbours are other ids, in order of distance, then id;
fewer than k where the table has fewer. A row with a null id or a null
vector is neither searched nor found; a null component counts as negative.
Repeated rows count once; an id with several vectors is a query, and may be
found, once for each code. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import materialize

BITS = 64
WIDEST = 16  # bits of a segment at most
FIRST_RADIUS = 1  # probed in the first round, balls this small being cheap
K = 10
QUERY_STEP = 100  # every id divisible by it is a query


def sign_code(vector: str, words: int = 1) -> Column:
    """The signs of ``64 * words`` components, as a struct of longs ``w0``, ``w1``, ...;
    a component that is null or missing counts as negative."""
    v = F.col(vector)

    def sign(at: Column, bit: Column) -> Column:
        return F.when(F.get(v, at) >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), bit)
                      ).otherwise(F.lit(0).cast("long"))

    def word(w: int) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"),
                           lambda acc, b: acc.bitwiseOR(sign(b + BITS * w, b)))

    return F.when(v.isNotNull(), F.struct(*[word(w).alias(f"w{w}") for w in range(words)]))


def _words(df: DataFrame, code: str) -> list[str]:
    return df.schema[code].dataType.names


def _distance(a: str, b: str, words: list[str]) -> Column:
    return reduce(Column.__add__, [F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}")))
                                   for w in words])


def _cuts(codes: int, words: int) -> list[tuple[int, int, int]]:
    """(word, shift, width) of the segments: about ``log2`` of the codes wide, so
    a bucket holds a few codes whatever their number, and 16 bits at most, so
    balls stay small."""
    m = max(math.ceil(BITS / max(math.log2(max(codes, 2)), 4)), BITS // WIDEST)
    edges = [BITS * k // m for k in range(m + 1)]
    return [(w, lo, hi - lo) for w in range(words) for lo, hi in zip(edges, edges[1:])]


def _values(code: str, cuts: list[tuple[int, int, int]], radii: range) -> Column:
    """(seg, value) of a code for every segment and every value whose distance
    from the code's own lies in ``radii``."""
    out = []
    for seg, (word, shift, width) in enumerate(cuts):
        own = F.shiftrightunsigned(F.col(f"{code}.w{word}"), shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        masks = [sum(1 << i for i in at) for r in radii for at in combinations(range(width), r)]
        if masks:
            out.append(F.transform(F.expr(f"array({', '.join(map(str, masks))})"),
                                   _probe(seg, own)))
    return F.explode(F.concat(*out))


def _probe(seg: int, own: Column) -> Callable[[Column], Column]:
    return lambda mask: F.struct(F.lit(seg).alias("seg"),
                                 own.cast("int").bitwiseXOR(mask).alias("value"))


def topk_codes(entries: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the ``k`` nearest other ids of
    every query. Both inputs are (id, code) with distinct rows; a code is a
    struct of longs as ``sign_code`` makes it, or one long."""
    if entries.schema["code"].dataType.typeName() == "long":
        one = F.struct(F.col("code").alias("w0")).alias("code")
        entries, queries = entries.select("id", one), queries.select("id", one)
    words = _words(entries, "code")
    some = Window.partitionBy("code").orderBy("id")
    codes = materialize(entries.withColumn("n", F.row_number().over(some))
                        .filter(F.col("n") <= k + 1)
                        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    size = codes.agg(F.count(F.lit(1)).alias("codes"), F.sum(F.size("ids")).alias("ids")).first()
    cuts, total = _cuts(size["codes"], len(words)), size["ids"] or 0
    table = codes.select("code", F.size("ids").alias("ids"),
                         _values("code", cuts, range(1)).alias("at")).select("code", "ids", "at.*")
    active = queries.select(F.col("code").alias("q")).distinct()
    found = active.sparkSession.createDataFrame(
        [], "q {0}, code {0}, ids int".format(entries.schema["code"].dataType.simpleString()))
    done = []
    radii = range(FIRST_RADIUS + 1)
    while radii.start <= max(width for *_, width in cuts):
        probes = active.select("q", _values("q", cuts, radii).alias("at")).select("q", "at.*")
        met = probes.join(table, ["seg", "value"]).select("q", "code", "ids")
        found = materialize(found.unionByName(met).distinct())
        covered = len(cuts) * radii.stop - 1
        near = _distance("q", "code", words) <= covered
        counts = found.groupBy("q").agg(
            F.sum(F.when(near, F.col("ids")).otherwise(0)).alias("near"),
            F.sum("ids").alias("all"))
        state = materialize(active.join(counts, "q", "left").select("q", F.coalesce(
            (F.col("near") >= k + 1) | (F.col("all") >= total), F.lit(False)).alias("done")))
        done.append(found.join(state.filter("done"), "q", "left_semi"))
        active = state.filter("NOT done").select("q")
        if active.isEmpty():
            break
        found = found.join(active, "q", "left_semi")
        radii = range(radii.stop, radii.stop + 1)
    near = reduce(DataFrame.unionByName, done).withColumn("distance", _distance("q", "code", words))
    # Whole distances settle the order; ids of the codes that can still matter follow.
    spent = Window.partitionBy("q").orderBy("distance")
    closer = F.sum("ids").over(spent.rangeBetween(Window.unboundedPreceding, -1))
    nearest = (near.withColumn("closer", F.coalesce(closer, F.lit(0)))
               .filter(F.col("closer") <= k).select("q", "code", "distance"))
    best = Window.partitionBy("q").orderBy("distance", "id")
    ids = (nearest.join(codes, "code").select("q", "distance", F.explode("ids").alias("id"))
           .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
           .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("distance", "id")))
                             .alias("list")))
    other = F.filter("list", lambda e: e["id"] != F.col("query_id"))
    return (queries.select(F.col("id").alias("query_id"), F.col("code").alias("q"))
            .join(ids, "q").select("query_id", F.posexplode(F.slice(other, 1, k)))
            .select("query_id", (F.col("pos") + 1).alias("rank"),
                    F.col("col.id").alias("neighbor_id"), F.col("col.distance").alias("distance")))


def topk_search(vectors: DataFrame, k: int = K, step: int = QUERY_STEP, id_col: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest other rows, by Hamming distance of sign codes, of
    every row whose id is divisible by ``step``."""
    wide = vectors.agg(F.max(F.size(vector))).first()[0] or 0
    words = max(1, -(-wide // BITS))
    coded = materialize(vectors.select(F.col(id_col).alias("id"), sign_code(vector, words).alias("code"))
                        .filter("id IS NOT NULL AND code IS NOT NULL").distinct())
    return topk_codes(coded, coded.filter(F.col("id") % step == 0), k)


def topk_sql(k: int = K, step: int = QUERY_STEP) -> str:
    """DuckDB SQL of ``topk_search`` over ``embeddings`` (brute force)."""
    return f"""
WITH w AS (SELECT coalesce(max(len(embedding)), 0) AS wide FROM embeddings),
e AS (SELECT DISTINCT vec_id AS id, list_transform(range(1, wide + 1),
      lambda i: coalesce(embedding[i] >= 0, false)) AS code
      FROM embeddings, w WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT q.id AS query_id, q.code AS own, e.id AS neighbor_id, CAST(len(list_filter(range(1, wide + 1),
      lambda i: q.code[i] <> e.code[i])) AS INTEGER) AS distance
      FROM w, e AS q JOIN e ON q.id % {step} = 0 AND q.id <> e.id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, distance FROM
(SELECT *, row_number() OVER (PARTITION BY query_id, own ORDER BY distance, neighbor_id) AS rank
FROM d) WHERE rank <= {k}"""
