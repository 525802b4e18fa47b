"""Arrival-ordered enrichment of a raw stream by an enrichment stream.

Semantics of the reference's broadcast process function: a raw record is
enriched with the latest enrichment for its key that had *arrived* before
it; it is never revisited, never waits, and has no time bound. A native
stream-stream outer join is not this (it needs watermarks and waits).

Spark plan: both streams are unioned into one tagged stream, grouped by
``(key, salt)`` and run through ``applyInPandasWithState`` (Arrow batches
sliced per group; no per-row Python on the way in). The state
per key is its latest enrichment (value, timestamp, arrival). Inside a
micro-batch the order is:

* with ``arrival_col``: rows are put in arrival order (ties: enrichments
  first unless ``enrichment_first_on_tie=False``); each raw row gets the
  latest enrichment before it, starting from the stored state;
* without it: the batch's enrichments are applied first (newest
  ``timestamp`` wins), then the raw rows see the result.

Across micro-batches the later batch wins (arrival), whatever the
``timestamp``. With ``arrival_col`` the batches themselves must come in
arrival order: a row that arrived before its key's stored enrichment would
get a later value, and raises instead. The state lives in the checkpoint's state store (RocksDB
recommended, see ``session.RECOMMENDED_CONF``), so unlike the reference,
enrichments survive a restart (J4).

Hot keys: a raw row's salt comes from a hash of the row, and each enrichment
row is replicated to all ``salt_buckets`` salts (all keys, or only
``hot_keys``). Every ``(key, salt)`` group therefore sees every enrichment of
its key and 1/S of its raw rows, so the state stays identical across salts
while one key's raw rows are spread over S groups (and tasks). The
micro-batch size is bounded by the source (``maxFilesPerTrigger``); one group
buffers only its share of one batch.

Key groups: with ``key_groups=B`` the grouping key is a hash of the key into
B groups; a group's state holds the latest enrichment of each of its keys as
sorted arrays, and its rows are handled as vectorized runs per key. This
pays PySpark's per-group cost once per group instead of once per key.
``plan_state_layout`` chooses hot keys and B from one per-key count.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from pyspark import cloudpickle

from rivulet.sources.fs import exists, read_text, write_text

# The group function runs in Python workers, which may not have this package on
# their path: ship this module's code inside the pickled function.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_STATE_SALT_BUCKETS = 4

_OUT_SCHEMA = T.StructType([
    T.StructField("event_time", T.LongType(), True),
    T.StructField("data", T.IntegerType(), True),
    T.StructField("enrichment", T.StringType(), True),
])


# State of one group: the latest enrichment of each of its keys, as parallel
# arrays sorted by key (one key per group unless key groups are used).
_STATE_SCHEMA = T.StructType([
    T.StructField("keys", T.ArrayType(T.IntegerType(), False), False),
    T.StructField("enrichments", T.ArrayType(T.StringType(), True), False),
    T.StructField("arrivals", T.ArrayType(T.LongType(), False), False),
])


def _lookup_fn(ordered: bool, enrichment_first_on_tie: bool):
    """Per ``(group, salt)``: the lookups of all keys of the group at once.

    Rows are sorted by (key, order); inside each key's run the last
    enrichment at or before a row is found with one running maximum, and a
    row with none takes the key's stored value.
    """

    def fn(group, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        parts = list(chunks)
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        if pdf.empty:
            return
        is_enr = pdf["is_enrichment"].to_numpy(dtype=bool)
        if group[0] is None or pd.isna(group[0]):  # null keys: nothing can match
            raw = ~is_enr
            if raw.any():
                yield pd.DataFrame({"event_time": pdf["event_time"][raw].astype("Int64").to_numpy(),
                                    "data": pd.array([None] * int(raw.sum()), dtype="Int32"),
                                    "enrichment": pd.array([None] * int(raw.sum()), dtype="string")})
            return
        keys = pdf["k"].to_numpy(dtype=np.int64)
        values = pdf["enrichment"].to_numpy(dtype=object)
        stamps = pdf["timestamp"].to_numpy()
        arrivals = pdf["arrival"].to_numpy()
        event_time = pdf["event_time"]
        if ordered:
            tie = np.where(is_enr, 0, 1) if enrichment_first_on_tie else np.where(is_enr, 1, 0)
            order = np.lexsort((tie, arrivals, keys))
        else:
            # Enrichments first, newest timestamp last; then the raw rows.
            phase = np.where(is_enr, 0, 1)
            order = np.lexsort((arrivals, stamps, phase, keys))
        is_enr, keys, values = is_enr[order], keys[order], values[order]
        stamps, arrivals, event_time = stamps[order], arrivals[order], event_time.iloc[order]

        n = len(keys)
        idx = np.arange(n)
        is_start = np.r_[True, keys[1:] != keys[:-1]]  # first row of a key's run
        starts = np.flatnonzero(is_start)
        run_start = np.maximum.accumulate(np.where(is_start, idx, 0))
        # Earlier runs only ever contribute values below run_start.
        last = np.maximum.accumulate(np.where(is_enr, idx, run_start - 1))
        in_run = last >= run_start

        if state.exists:
            st_keys, st_vals, st_arr = state.get
            st_keys = np.asarray(st_keys, dtype=np.int64)
            st_vals = np.asarray(st_vals, dtype=object)
            st_arr = np.asarray(st_arr, dtype=np.int64)
        else:
            st_keys = np.empty(0, np.int64)
            st_vals = np.empty(0, object)
            st_arr = np.empty(0, np.int64)
        fallback = np.full(n, None, dtype=object)
        if len(st_keys):
            j = np.minimum(np.searchsorted(st_keys, keys), len(st_keys) - 1)
            hit = st_keys[j] == keys
            if ordered:
                late = arrivals < st_arr[j]
                if not enrichment_first_on_tie:
                    late |= ~is_enr & (arrivals == st_arr[j])
                if (hit & late).any():
                    k = np.flatnonzero(hit & late)[0]
                    raise ValueError(
                        f"key {keys[k]}: arrival {arrivals[k]} comes after the batch of "
                        f"enrichment {st_arr[j][k]}; batches must follow the arrival order")
            fallback[hit] = st_vals[j[hit]]
        looked_up = np.where(in_run, values[np.maximum(last, 0)], fallback)

        ends = np.r_[starts[1:] - 1, n - 1]
        has = last[ends] >= starts
        if has.any():
            src = last[ends][has]
            upd_keys = keys[src]
            keep = ~np.isin(st_keys, upd_keys)
            new_keys = np.concatenate([st_keys[keep], upd_keys])
            by_key = np.argsort(new_keys, kind="stable")
            state.update((
                new_keys[by_key].tolist(),
                np.concatenate([st_vals[keep], values[src]])[by_key].tolist(),
                np.concatenate([st_arr[keep], arrivals[src].astype(np.int64)])[by_key].tolist(),
            ))

        raw = ~is_enr
        if raw.any():
            yield pd.DataFrame({
                "event_time": event_time[raw].astype("Int64").to_numpy(),
                "data": pd.array(keys[raw].astype(np.int32), dtype="Int32"),
                "enrichment": pd.array(looked_up[raw], dtype="string"),
            })

    return fn


def _salt(c):
    # Non-nullable on both sides, whatever a side's plan is in a batch: the
    # grouping key schema is checked against the state store on restart.
    return F.coalesce(c.cast("int"), F.lit(0)).alias("salt")


_MIN_ARRIVAL = -(2 ** 63)


@dataclass(frozen=True)
class StateLayout:
    """What a checkpoint's state depends on: salts per hot key (None: every
    key has ``salt_buckets``), key groups, state partitions."""

    salt_buckets: int = DEFAULT_STATE_SALT_BUCKETS
    hot_keys: dict[int, int] | None = None
    key_groups: int | None = None
    partitions: int | None = None

    def to_json(self) -> str:
        hot = None if self.hot_keys is None else sorted(self.hot_keys.items())
        return json.dumps({**asdict(self), "hot_keys": hot}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "StateLayout":
        kept = json.loads(text)
        if kept["hot_keys"] is not None:
            kept["hot_keys"] = {int(k): int(n) for k, n in kept["hot_keys"]}
        return StateLayout(**kept)


def layout_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}.layout"


def kept_layout(spark: SparkSession, checkpoint: str) -> StateLayout | None:
    """The layout written beside a checkpoint at its first start, if any."""
    path = layout_path(checkpoint)
    return StateLayout.from_json(read_text(spark, path)) if exists(spark, path) else None


def keep_layout(spark: SparkSession, checkpoint: str, layout: StateLayout) -> StateLayout:
    """Write the layout at a checkpoint's first start; later, refuse another:
    rows would be sent to groups that lack their keys' state."""
    kept = kept_layout(spark, checkpoint)
    if kept is None:
        write_text(spark, layout_path(checkpoint), layout.to_json())
        return layout
    if kept != layout:
        raise ValueError(f"{checkpoint} holds state of {kept}, not of {layout}")
    return kept


def find_hot_keys(df: DataFrame, key_col: str, min_share: float = 0.01) -> list:
    """Keys that hold at least ``min_share`` of the rows of ``df`` (exact).

    One distributed count per key; at most ``1 / min_share`` keys can pass
    the filter, so the list brought to the driver has a proven size bound.
    """
    return sorted(plan_state_layout(df, key_col, min_share)[0])


def plan_state_layout(df: DataFrame, key_col: str, min_share: float = 0.01,
                      keys_per_group: int = 64, min_groups: int = 1) -> tuple[dict, int]:
    """``(hot_keys, key_groups)`` (hot keys with their salts, by share: each
    salt gets about ``min_share`` of the rows) for ``enrich_stateful`` from one per-key
    count of ``df`` (e.g. the history of the raw stream).

    A row count (no column data read), then a single aggregation over the
    per-key counts returns the number of keys and the hot keys; at most
    ``1 / min_share`` keys can be hot, so that list is bounded.
    ``key_groups`` gives about ``keys_per_group`` keys per group.
    """
    n_rows = df.count()
    keyed = df.filter(F.col(key_col).isNotNull()).groupBy(key_col).count()
    salts = F.ceil(F.col("count") / F.lit(max(min_share * n_rows, 1e-9))).cast("int")
    hot_if = F.when(F.col("count") >= F.lit(min_share * n_rows),
                    F.struct(F.col(key_col).alias("key"), F.greatest(salts, F.lit(2)).alias("n")))
    stats = keyed.agg(F.count(F.lit(1)).alias("keys"),
                      F.collect_list(hot_if).alias("hot")).first()
    n_keys = int(stats["keys"] or 0)
    groups = max(int(min_groups), -(-n_keys // int(keys_per_group)), 1)
    return ({r["key"]: r["n"] for r in sorted(stats["hot"])} if n_rows else {}), groups


def _tagged_union(raw: DataFrame, enr: DataFrame, arrival_col: str | None,
                  salt_buckets: int, hot_keys=None, key_groups: int | None = None) -> DataFrame:
    """One stream of both inputs: (gkey, salt, is_enrichment, arrival,
    event_time, timestamp, enrichment). Unused fields are 0, not null, so
    the integer columns reach pandas as integers."""
    if arrival_col:
        arrival = F.coalesce(F.col(arrival_col).cast("bigint"), F.lit(_MIN_ARRIVAL))
    else:
        arrival = F.lit(0).cast("bigint")
    n = int(salt_buckets)
    raw_salt = F.pmod(F.xxhash64(F.col("event_time"), F.col("data"), arrival), F.lit(n))
    replicas = F.sequence(F.lit(0), F.lit(n - 1))
    if hot_keys is not None:
        # Only the listed keys are spread, each over its own number of salts.
        salts = hot_keys if isinstance(hot_keys, dict) else dict.fromkeys(hot_keys, n)

        def salts_of(c):
            if not salts:
                return F.lit(1)
            of = F.create_map(*[F.lit(int(v)) for item in salts.items() for v in item])
            return F.coalesce(F.element_at(of, F.col(c).cast("int")), F.lit(1))

        raw_salt = F.pmod(F.xxhash64(F.col("event_time"), F.col("data"), arrival),
                          salts_of("data"))
        replicas = F.sequence(F.lit(0), salts_of("key") - 1)

    def group_of(k):
        if not key_groups:
            return k.alias("gkey")
        return F.when(k.isNotNull(), F.pmod(F.xxhash64(k), F.lit(int(key_groups))).cast("int")) \
            .alias("gkey")

    raw_t = raw.select(
        group_of(F.col("data").cast("int")),
        F.col("data").cast("int").alias("k"),
        _salt(raw_salt),
        F.lit(False).alias("is_enrichment"),
        arrival.alias("arrival"),
        F.col("event_time").cast("bigint").alias("event_time"),
        F.lit(0).cast("bigint").alias("timestamp"),
        F.lit(None).cast("string").alias("enrichment"),
    )
    # A null key matches nothing (as in the lookup join), so such an
    # enrichment can never be seen and is not sent.
    enr_t = (enr.filter(F.col("key").isNotNull())
             .withColumn("_replica", F.explode(replicas))
             .select(
                 group_of(F.col("key").cast("int")),
                 F.col("key").cast("int").alias("k"),
                 _salt(F.col("_replica")),
                 F.lit(True).alias("is_enrichment"),
                 arrival.alias("arrival"),
                 F.lit(0).cast("bigint").alias("event_time"),
                 F.coalesce(F.col("timestamp").cast("bigint"), F.lit(0).cast("bigint"))
                 .alias("timestamp"),
                 F.col("enrichment").cast("string").alias("enrichment"),
             ))
    return raw_t.unionByName(enr_t)


def enrich_stateful(raw: DataFrame, enrichments: DataFrame, arrival_col: str | None = None,
                    enrichment_first_on_tie: bool = True,
                    salt_buckets: int = DEFAULT_STATE_SALT_BUCKETS,
                    hot_keys=None, key_groups: int | None = None) -> DataFrame:
    """RAW stream + ENRICHMENT stream -> (event_time, data, enrichment) in
    arrival order; add key and partition with ``operators.to_enriched``.

    ``arrival_col`` (present in both inputs) orders rows inside a
    micro-batch; across micro-batches the batch order is the arrival order.

    ``hot_keys=None`` spreads every key over ``salt_buckets`` groups. A list
    (e.g. from ``find_hot_keys`` over history), or a dict with each key's
    number of salts (``plan_state_layout``), spreads only those keys and
    keeps every other key in one group, saving the replication of their
    enrichments.

    ``key_groups=None`` keeps one state group per key. ``key_groups=B``
    hashes keys into B groups whose state holds all their keys' values as
    arrays: far fewer groups (PySpark's per-group cost is ~2 ms), at the price
    of rewriting a group's arrays when any of its keys changes -- choose B so
    a group holds tens to hundreds of keys.

    Salting and key groups are part of the state layout: keep
    ``salt_buckets``, ``hot_keys`` and ``key_groups`` fixed for the life of a
    checkpoint (``keep_layout`` writes them down and refuses others).
    """
    tagged = _tagged_union(raw, enrichments, arrival_col, salt_buckets, hot_keys, key_groups)
    return tagged.groupBy("gkey", "salt").applyInPandasWithState(
        _lookup_fn(arrival_col is not None, enrichment_first_on_tie),
        outputStructType=_OUT_SCHEMA,
        stateStructType=_STATE_SCHEMA,
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )
