"""Hard negatives by threshold joins on an inverted index (L2AP).

Every anchor has windows of scores; a window is filled with the best ``k``
rows that fit it. First comes one window per anchor for its positives, then
one per positive for its negatives. Rows are dealt into shards and anchors
into chunks of bounded size, and each shard meets each chunk in one task.

There, an anchor's components stand in an inverted index, but for a tail of
small ones: as long as the norm of the tail times the largest norm of a row is
under the threshold, a row cannot reach it by the tail alone. Partial scores
are added up over the indexed components, block by block; pairs whose partial
score and remaining norms cannot reach the threshold are pruned, the others
are finished and checked exactly. The threshold starts high and is lowered
until the windows are full or reach their lower end.

A first pass over one shard in ``FIRST_SHARDS`` gives every window a score
that ``k`` rows are known to reach; the pass over all shards starts from there
and so sends few rows on. Both are exact: what stays out cannot be among the
best. Scores are integers, exact in double arithmetic, or in Python's integers
where they would not be.

Defined results: a row takes no part with a null id, label or vector, or any
component null or not finite. Repeated rows (id, label and vector alike) count
once; a row with an anchor's id is never its positive. Vectors of different
lengths are compared over the components that both have. Scores must fit a
long. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import materialize

SCALE = 256  # fixed by the contract, as are the next five
ANCHOR_STEP, SHIFT_STEP, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score, in hundredths of the positive's
SHARD_ROWS, CHUNK_ANCHORS = 4096, 1024
SHARD_BYTES = 32 << 20
FIRST_SHARDS = 16
DIMS_AT_ONCE = 16
START, LOWER = 0.6, 0.8
SLACK = 1 + 1e-9  # for the rounding of norms


# --- in a task ----------------------------------------------------------------

def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of integers as the rows of a matrix, short ones filled with 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    length = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    wide = int(length.max(initial=0))
    if len(values) == wide * len(length):
        return values.reshape(len(length), wide)
    out = np.zeros((len(length), wide), np.int64)
    out[np.arange(wide) < length[:, None]] = values
    return out


def same_space(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both over the components they share, as numbers whose products and
    sums are exact."""
    wide = min(a.shape[1], b.shape[1])
    a, b = a[:, :wide], b[:, :wide]
    most = [float(np.abs(x.astype(np.float64)).max(initial=0.0)) for x in (a, b)]
    kind = np.float64 if most[0] * most[1] * max(wide, 1) < 2.0 ** 52 else object
    return a.astype(kind), b.astype(kind)


def tail_norms(x: np.ndarray) -> np.ndarray:
    """For each row and k, the norm of its components from k on."""
    squares = x.astype(np.float64) ** 2
    out = np.zeros((len(x), x.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return out * SLACK


class Joiner:
    """All pairs of an anchor and a row of one shard that reach a threshold."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        anchors, rows = same_space(anchors, rows)
        order = np.argsort(-np.abs(anchors.astype(np.float64)).sum(axis=0), kind="stable")
        self.anchors, self.rows = anchors[:, order], rows[:, order]
        self.anchor_tail, self.row_tail = tail_norms(self.anchors), tail_norms(self.rows)
        self.largest = float(self.row_tail[:, 0].max(initial=0.0))

    def reach(self) -> np.ndarray:
        """The most that each anchor can score here."""
        return self.anchor_tail[:, 0] * self.largest

    def pairs(self, at: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """(which of ``at``, row, score) of the pairs with a score of at least
        ``least``, for the anchors ``at``."""
        wide = self.anchors.shape[1]
        # Components from ``cut`` on are omitted from the index.
        cut = (self.anchor_tail[at] * self.largest >= least[:, None]).sum(axis=1)
        cut = np.minimum(cut, wide)
        order = np.argsort(-cut, kind="stable")  # the most indexed anchors first
        cut, least_of = cut[order], least[order]
        tail, index = self.anchor_tail[at][order], self.anchors[at][order].copy()
        index[np.arange(wide) >= cut[:, None]] = 0
        partial = np.zeros((len(at), len(self.rows)), index.dtype)
        alive = np.ones(partial.shape, bool)
        upto = np.zeros(len(at), np.int64)
        for k in range(0, wide, DIMS_AT_ONCE):
            indexed = int((cut > k).sum())
            if not indexed:
                break
            dims = slice(k, min(k + DIMS_AT_ONCE, wide))
            partial[:indexed] += index[:indexed, dims] @ self.rows[:, dims].T
            upto[:indexed] = np.minimum(dims.stop, cut[:indexed])
            rest = tail[np.arange(len(at)), upto][:, None] * self.row_tail[:, upto].T
            alive = partial + rest + 1e-6 >= least_of[:, None]
            if alive.sum() * 8 < alive.size:
                break
        else:
            rest = tail[np.arange(len(at)), upto][:, None] * self.row_tail[:, upto].T
            alive = partial + rest + 1e-6 >= least_of[:, None]
        i, j = np.nonzero(alive)
        score = partial[i, j]
        left = np.arange(wide) >= upto[:, None]
        whole = self.anchors[at][order]
        for s in range(0, len(i), 1 << 16):
            part = slice(s, s + (1 << 16))
            score[part] += (np.where(left[i[part]], whole[i[part]], 0) * self.rows[j[part]]).sum(axis=1)
        good = score >= least_of[i]
        return order[i[good]], j[good], score[good]


def fill(joiner: Joiner, windows: list[list[tuple]], fits: np.ndarray, ids: np.ndarray,
         k: int) -> list[tuple]:
    """The best ``k`` rows of every window, as (anchor, window, row, score).

    ``windows`` holds, for each anchor, (name, low, high, start): scores from
    low to high fit (None: no bound), and ``k`` rows are known to reach start.
    ``fits`` tells which rows an anchor may take; of equal scores the smaller
    id comes first."""
    reach = joiner.reach()
    out: list[tuple] = []
    ends, tops = [], []
    for a, own in enumerate(windows):
        floor = [max([x for x in (low, start) if x is not None], default=-np.inf)
                 for _, low, _, start in own]
        ends.append(min(floor, default=np.inf))
        tops.append(max([reach[a] if high is None else min(high, reach[a])
                         for _, _, high, _ in own], default=0.0))
    ends, least = np.array(ends, np.float64), np.array(tops, np.float64) * START
    known = np.array([any(w[3] is not None for w in own) for own in windows], bool)
    least = np.where(known, ends, np.maximum(least, ends))  # a known start needs no search
    active = np.flatnonzero(ends < np.inf)
    while len(active):
        which, rows, scores = joiner.pairs(active, least[active])
        ok = fits[active[which], rows]
        which, rows, scores = which[ok], rows[ok], scores[ok]
        order = np.lexsort((ids[rows], -scores, which)) if scores.dtype != object else np.array(
            sorted(range(len(rows)), key=lambda x: (which[x], -scores[x], ids[rows[x]])), np.int64)
        which, rows, scores = which[order], rows[order], scores[order]
        first = np.searchsorted(which, np.arange(len(active) + 1))
        again = []
        for n, a in enumerate(active):
            own = slice(first[n], first[n + 1])
            made, full = [], True
            for name, low, high, start in windows[a]:
                s = scores[own]
                inside = np.ones(len(s), bool)
                if low is not None:
                    inside &= s >= low
                if high is not None:
                    inside &= s <= high
                best = np.flatnonzero(inside)[:k]
                full &= len(best) == k
                made += [(a, name, rows[own][b], int(s[b])) for b in best]
            if full or least[a] <= ends[a] or least[a] <= -reach[a]:
                out += made
            else:
                again.append(a)
        active = np.array(again, np.int64)
        down = np.where(least > 0.05 * reach, least * LOWER, -np.inf)
        least = np.maximum(down, ends)
    return out


def in_task(same_label: bool, k: int):
    """The function of one chunk of anchors and one shard of rows."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            ids = rows["id"].to_numpy()
            alike = anchors["anchor_label"].to_numpy()[:, None] == rows["label"].to_numpy()
            other = anchors["anchor_id"].to_numpy()[:, None] != ids
            fits = alike & other if same_label else ~alike
            windows = [[(w["w"], w["low"], w["high"], w["start"]) for w in own]
                       for own in anchors["windows"].to_pylist()]
            joiner = Joiner(matrix(anchors["anchor_v"]), matrix(rows["v"]))
            a = anchors["a"].to_numpy()
            found = [(int(a[i]), w, int(ids[j]), s) for i, w, j, s in
                     fill(joiner, windows, fits, ids, k)]
        columns = list(zip(*found)) or [(), (), (), ()]
        return pa.table({"a": pa.array(columns[0], pa.int64()), "w": pa.array(columns[1], pa.int32()),
                         "id": pa.array(columns[2], pa.int64()),
                         "score": pa.array(columns[3], pa.int64())})

    return run


# --- over the cluster -----------------------------------------------------------

WINDOW = "struct<w:int,low:bigint,high:bigint,start:bigint>"


def best_in_windows(anchors: DataFrame, rows: DataFrame, windows: DataFrame, shards: int, chunks: int,
                    same_label: bool, k: int) -> DataFrame:
    """(a, w, id, score, rank): the best ``k`` rows of each window of ``windows``
    (a, w, low, high)."""

    def search(sharded: DataFrame, windows: DataFrame, shard_list: Column) -> DataFrame:
        per_anchor = windows.groupBy("a").agg(F.collect_list(F.struct(
            "w", "low", "high", "start")).alias("windows"))
        left = anchors.join(per_anchor, "a").withColumn("anchor_shard", F.explode(shard_list))
        right = sharded.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        met = (left.groupBy("anchor_shard", "anchor_chunk").cogroup(right.groupBy("shard", "chunk"))
               .applyInArrow(in_task(same_label, k), "a long, w int, id long, score long"))
        best = Window.partitionBy("a", "w").orderBy(F.desc("score"), "id")
        return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    none = windows.withColumn("start", F.lit(None).cast("bigint"))
    some = rows.filter(F.col("shard") % FIRST_SHARDS == 0)
    first = search(some, none, F.sequence(F.lit(0), F.lit(shards - 1), F.lit(FIRST_SHARDS)))
    start = materialize(first.filter(F.col("rank") == k).select("a", "w", F.col("score").alias("start")))
    known = windows.join(start, ["a", "w"], "left")
    return materialize(search(rows, known, F.sequence(F.lit(0), F.lit(shards - 1))))


def usable(vectors: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """(id, label, v): the rows that take part, labels shifted, components as
    integers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    shifted = F.when(F.col("id") % SHIFT_STEP == 0, (F.col("label") + 1) % LABELS)
    return (vectors.filter(F.col(vector).isNotNull() & good)
            .select(F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
                    F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))
            .filter("id IS NOT NULL AND label IS NOT NULL")
            .select("id", F.coalesce(shifted, "label").alias("label"), "v").distinct())


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
                   label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor and each of its positives, the best
    rows of another label with a score of ``low`` to ``high`` hundredths of
    the positive's."""
    rows = materialize(usable(vectors, id_col, vector, label))
    anchor = F.col("id") % ANCHOR_STEP == 0
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(anchor).alias("anchors"),
                    F.max(F.size("v")).alias("wide")).first()
    per_shard = max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * max(size["wide"] or 1, 1))))
    shards = -(-size["rows"] // per_shard) or 1
    chunks = -(-size["anchors"] // min(CHUNK_ANCHORS, per_shard)) or 1

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("id", "label", "v"), F.lit(n)).cast("int")

    anchors = materialize(rows.filter(anchor).select(
        F.monotonically_increasing_id().alias("a"), F.col("id").alias("anchor_id"),
        F.col("label").alias("anchor_label"), F.col("v").alias("anchor_v"),
        dealt(chunks).alias("anchor_chunk")))
    sharded = rows.withColumn("shard", dealt(shards))
    every = anchors.select("a", F.lit(0).alias("w"), F.lit(None).cast("bigint").alias("low"),
                           F.lit(None).cast("bigint").alias("high"))
    pos = best_in_windows(anchors, sharded, every, shards, chunks, True, positives).select(
        "a", F.col("rank").alias("w"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    p = F.col("positive_score")
    between = pos.select("a", "w", F.ceil(p * low / F.lit(100).cast("decimal(3,0)")).cast("bigint").alias("low"),
                         F.floor(p * high / F.lit(100).cast("decimal(3,0)")).cast("bigint").alias("high"))
    neg = best_in_windows(anchors, sharded, between, shards, chunks, False, negatives)
    return (neg.join(pos, ["a", "w"]).join(anchors.select("a", "anchor_id"), "a")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def negatives_sql() -> str:
    """DuckDB SQL of ``hard_negatives`` over ``embeddings`` (brute force)."""
    return f"""
WITH e AS (SELECT DISTINCT vec_id AS id,
           CASE WHEN vec_id % {SHIFT_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.id AS anchor_id, r.id, q.label = r.label AS alike,
      CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
      FROM e AS q JOIN e AS r ON q.id % {ANCHOR_STEP} = 0 AND q.id <> r.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM
      (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n FROM s
       WHERE alike) WHERE n <= {POSITIVES}),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id
      ORDER BY score DESC, id) AS rank, id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id) WHERE NOT alike
      AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {NEGATIVES}"""
