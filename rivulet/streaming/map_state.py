"""Arrival-ordered enrichment with a state entry for each key.

The same lookups as ``arrival.enrich_stateful``, on Spark's
``transformWithState``: a group's state is a map from key to its latest
(enrichment, arrival). A changed key writes its own entry, and a lookup reads
the entries of the batch's keys only, where the array state of
``enrich_stateful`` reads and rewrites a group's keys as one value. It can
start from given values, such as the state of another query
(``relayout.read_state``), whatever that one's layout. Needs the RocksDB state
store.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rivulet.streaming.arrival import DEFAULT_STATE_SALT_BUCKETS, _tagged_union

# The processor runs in Python workers: ship this module's code with it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUT = "event_time bigint, data int, enrichment string"
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class LatestByKey(StatefulProcessor):
    """Lookups of one (group, salt); its map has the latest value of each key."""

    def __init__(self, enrichment_first_on_tie: bool):
        self.first = enrichment_first_on_tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getMapState("latest", "k int", "enrichment string, arrival bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        rows = initialState.sort_values(["arrival", "enrichment"], na_position="first")
        for k, value, arrival in zip(rows["k"], rows["enrichment"], rows["arrival"]):
            self.latest.updateValue((int(k),), (None if pd.isna(value) else value, int(arrival)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        is_enr = pdf["is_enrichment"].to_numpy(dtype=bool)
        if pd.isna(key[0]):  # null keys: nothing can match
            yield self._out(pdf["event_time"][~is_enr], None, [None] * int((~is_enr).sum()))
            return
        keys, arrivals = pdf["k"].to_numpy(dtype=np.int64), pdf["arrival"].to_numpy(dtype=np.int64)
        values = pdf["enrichment"].to_numpy(dtype=object)
        by_value = np.array(["" if pd.isna(v) else "1" + v for v in values], dtype=object)
        order = np.array(sorted(range(len(keys)), key=lambda i: (
            keys[i], arrivals[i], is_enr[i] != self.first, by_value[i])), np.int64)
        out: list = [None] * len(keys)
        at = 0
        while at < len(order):  # one key's rows after another, one read and one write of its entry
            k = int(keys[order[at]])
            held = self.latest.getValue((k,)) if self.latest.containsKey((k,)) else None
            value, changed = (held[0] if held else None), None
            if held:
                self._after(k, arrivals[order[at]], held[1], is_enr[order[at]])
            while at < len(order) and keys[order[at]] == k:
                i = order[at]
                if is_enr[i]:
                    value = None if pd.isna(values[i]) else values[i]
                    changed = (value, int(arrivals[i]))
                else:
                    out[i] = value
                at += 1
            if changed:
                self.latest.updateValue((k,), changed)
        raw = np.flatnonzero(~is_enr)
        if len(raw):
            yield self._out(pdf["event_time"].iloc[raw], keys[raw], [out[i] for i in raw])

    def _after(self, key: int, arrival: int, held: int, is_enr: bool) -> None:
        if arrival < held or arrival == held and not self.first and not is_enr:
            raise ValueError(f"key {key}: arrival {arrival} comes after the batch of enrichment "
                             f"{held}; batches must follow the arrival order")

    @staticmethod
    def _out(event_time, keys, values) -> pd.DataFrame:
        data = pd.array([None] * len(values) if keys is None else keys.astype(np.int32), dtype="Int32")
        return pd.DataFrame({"event_time": event_time.astype("Int64").to_numpy(), "data": data,
                             "enrichment": pd.array(values, dtype="string")})

    def close(self) -> None:
        pass


def enrich_map_state(raw: DataFrame, enrichments: DataFrame, arrival_col: str,
                     enrichment_first_on_tie: bool = True,
                     salt_buckets: int = DEFAULT_STATE_SALT_BUCKETS, hot_keys=None,
                     key_groups: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """RAW stream + ENRICHMENT stream, both with ``arrival_col``, ->
    (event_time, data, enrichment) in arrival order. Salts and key groups as
    in ``enrich_stateful``; ``initial`` (key, enrichment, arrival) are the values
    that a new checkpoint starts from."""
    def tagged(r: DataFrame, e: DataFrame):
        return _tagged_union(r, e, arrival_col, salt_buckets, hot_keys, key_groups).groupBy("gkey", "salt")

    start = None
    if initial is not None:
        spark = raw.sparkSession
        none = spark.createDataFrame([], f"event_time bigint, data int, `{arrival_col}` bigint")
        start = tagged(none, initial.select(
            F.lit(0).cast("bigint").alias("timestamp"), "key", "enrichment",
            F.col("arrival").alias(arrival_col)))
    return tagged(raw, enrichments).transformWithStateInPandas(
        LatestByKey(enrichment_first_on_tie), _OUT, "Append", "None", initialState=start)
