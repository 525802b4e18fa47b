"""Mix sources to target weights by weighted fair queueing.

Each source queues its documents in a shuffled order, up to three times
over; a copy's virtual finish time is the source's words so far divided by
the source's target. Reading all copies in finish order until the total
budget is spent takes from every source about its target.

Running sums of a hot source are not made in one task: documents are dealt
into hash ranges, ranges are summed first, and a range starts from the sum
of those before it. The global order is found the same way: copies are
summed by range of finish time, and only the range that the budget ends in
is sorted.

Defined results: a null or empty text has size 0 and is never taken. Null
sources are one source, last in order. Repeated rows are mixed as separate
documents; rows that agree in id, size and content are interchangeable. A
null id is a value like any other. Extra columns are ignored (or carried as
they are by ``mix``). An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import WORD, text_or_empty
from rivulet.session import materialize

WEIGHTS = (5, 2, 1)  # repeating, over the sources in code point order
MAX_EPOCHS = 3
ROWS_PER_RANGE = 2_000
SEED = 8


def size_of(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, rank, rows, source_size, target) from one row per source
    (source, rows, source_size).

    Targets share all words by weight; one that would pass ``max_epochs``
    times its source stops there and the rest share what it leaves. In order
    of cap / weight the stopped sources come first, so running sums find
    them without a loop."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    w = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    every = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    w = (w.withColumn("left_words", F.sum("source_size").over(every)
                      - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("left_weight", F.sum("weight").over(every)
                     - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    fair = F.col("weight") * F.col("left_words") / F.col("left_weight")
    w = w.withColumn("stopped", F.col("cap") <= fair)
    first = F.min(F.when(~F.col("stopped"), F.struct(
        (F.col("cap") / F.col("weight")).alias("r"), "rank", "left_words", "left_weight")))
    w = w.withColumn("first", first.over(every))
    share = F.col("weight") * F.col("first.left_words") / F.col("first.left_weight")
    return w.select("source", "rank", "rows", "source_size",
                    F.least(F.col("cap").cast("double"),
                            F.coalesce(share, F.lit(0.0))).alias("target"))


def _range_of(key: Column, n: Column) -> Column:
    """Order-preserving: which of ``n`` equal parts of the 64-bit range a key is in."""
    part = F.floor((key.cast("double") / 2.0 ** 64 + 0.5) * n)
    return F.least(part, n - 1)


def _queued(docs: DataFrame, keep: Column, sources: DataFrame) -> DataFrame:
    """``keep`` and each row's place ``c`` (running words) in its source's queue.

    A source's queue is cut into ranges of about ``ROWS_PER_RANGE`` rows."""
    d, s = docs.alias("d"), sources.alias("s")
    ranges = (F.col("s.rows") / ROWS_PER_RANGE).cast("long") + 1
    d = (d.join(s, F.expr("d.source <=> s.source"))
         .select(keep, "d.size", "d.key", "d.tie", "s.rank", "s.source_size", "s.target",
                 _range_of(F.col("d.key"), ranges).alias("part")))
    sums = d.groupBy("rank", "part").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("rank", "part",
                         F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("start"))
    run = (Window.partitionBy("rank", "part").orderBy("key", "tie")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return d.join(starts, ["rank", "part"]).select(
        "__row", "size", "rank", "source_size", "target",
        (F.col("start") + F.sum("size").over(run)).alias("c"))


def _copies(max_epochs: int) -> Column:
    """A document's copies: finish time, source rank, place. Their order is total
    among documents with words: places of one source differ."""
    return F.transform(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda e: F.struct(
        ((F.col("c") + e * F.col("source_size")) / F.col("target")).alias("v"),
        F.col("rank").alias("rank"), (F.col("c") + e * F.col("source_size")).alias("place")))


def _cut(queued: DataFrame, rows: int, budget: int, max_epochs: int):
    """The last copy, in finish order, that the budget still pays; None if it
    pays none. Copies are summed by range of finish time (``v / (1 + v)`` cut
    evenly); only the range where the budget ends is sorted by rows."""
    n = rows * max_epochs // ROWS_PER_RANGE + 1
    c = (queued.filter("size > 0 AND target > 0")
         .select("size", F.explode(_copies(max_epochs)).alias("k"))
         .withColumn("part", F.floor(F.col("k.v") / (1 + F.col("k.v")) * n)))
    parts = c.groupBy("part").agg(F.sum("size").alias("words"), F.max("k").alias("last"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = materialize(parts.withColumn("upto", F.sum("words").over(upto)))
    whole = parts.filter(F.col("upto") <= budget).agg(
        F.max("last").alias("last"), F.max("part").alias("part"),
        F.max("upto").alias("spent")).first()
    over = parts.filter(F.col("upto") > budget).agg(F.min("part").alias("part")).first()
    if over["part"] is None:
        return whole["last"]
    spent = whole["spent"] or 0
    run = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (c.filter(F.col("part") == over["part"])
            .withColumn("upto", F.sum("size").over(run) + spent)
            .filter(F.col("upto") <= budget).agg(F.max("k").alias("last")).first())
    return last["last"] or whole["last"]


def _mixed(docs: DataFrame, keep: Column, text: str, id_col: str, source: str,
           weights: tuple[int, ...], max_epochs: int, narrow: bool) -> DataFrame:
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in sorted(docs.dtypes) if "map<" not in kind])
    d = docs.select(keep, F.col(source).alias("source"), size_of(text).alias("size"),
                    # Rows of one id, or of none, lie apart by their content.
                    F.xxhash64(F.col(id_col), tie, F.lit(SEED)).alias("key"), tie.alias("tie"))
    small = materialize(d.select(F.struct(F.col(f"__row.{id_col}")).alias("__row"),
                                 "source", "size", "key", "tie"))
    per_source = small.groupBy("source").agg(F.sum("size").alias("source_size"),
                                             F.count(F.lit(1)).alias("rows"))
    totals = materialize(per_source)
    t = totals.agg(F.sum("source_size").alias("words"), F.sum("rows").alias("rows")).first()
    budget, rows = t["words"] or 0, t["rows"] or 0
    sources = materialize(targets(totals, weights, max_epochs))
    queue = materialize(_queued(small, F.col("__row"), sources))
    cut = _cut(queue, rows, budget, max_epochs)
    if cut is None:
        copies = F.lit(0)
    else:
        last = F.struct(F.lit(cut["v"]).alias("v"), F.lit(cut["rank"]).alias("rank"),
                        F.lit(cut["place"]).cast("long").alias("place"))
        copies = F.when((F.col("size") > 0) & (F.col("target") > 0),
                        F.size(F.filter(_copies(max_epochs), lambda k: k <= last))).otherwise(0)
    if not narrow:
        queue = _queued(d, F.col("__row"), sources)
    return queue.withColumn("copies", copies)


def source_mixing(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                  source: str = "source", weights: tuple[int, ...] = WEIGHTS,
                  max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target, taken, copies.

    Reads the texts once for their sizes; the rest works on one narrow row
    per document."""
    out = _mixed(docs, F.struct(id_col).alias("__row"), text, id_col, source, weights,
                 max_epochs, narrow=True)
    return out.select(F.col(f"__row.{id_col}"), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"),
                      F.col("copies").cast("int").alias("copies"))


def mix(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: the rows of ``docs``, all their columns, each as often
    as the mix takes it (0 to ``max_epochs`` times). Whole rows are shuffled
    once, by (source, hash range)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    out = _mixed(docs, row, text, id_col, source, weights, max_epochs, narrow=False)
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))
    return out.select("__row", F.explode(times)).select("__row.*")
