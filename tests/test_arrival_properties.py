"""Property tests: arrival-ordered enrichment against a brute-force
definition on random inputs (keys, arrival ties, null values)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.operators.arrival_bounded import enrich_arrival_bounded

RAW_A = "event_time bigint, data int, arrival bigint"
ENR_A = "timestamp bigint, key int, enrichment string, arrival bigint"

KEYS = st.integers(min_value=0, max_value=4)
ARRIVALS = st.integers(min_value=0, max_value=30)
RAWS = st.lists(st.tuples(KEYS, ARRIVALS), min_size=1, max_size=40)
ENRS = st.lists(st.tuples(KEYS, ARRIVALS, st.one_of(st.none(), st.sampled_from("abcde"))),
                max_size=40)


def brute_force(raws, enrs, enrichment_first_on_tie):
    """For each raw (data, arrival): the value of the enrichment of the same
    key that comes last in (arrival, tie, input order) before the raw row."""
    enr_tie, raw_tie = (0, 1) if enrichment_first_on_tie else (1, 0)
    out = []
    for i, (data, arrival) in enumerate(raws):
        best, best_pos = None, None
        for j, (key, a, value) in enumerate(enrs):
            if key == data and (a, enr_tie) < (arrival, raw_tie):
                pos = (a, j)
                if best_pos is None or pos > best_pos:
                    best, best_pos = value, pos
        out.append((i, data, best))
    return sorted(out)


@settings(max_examples=12, deadline=None)
@given(RAWS, ENRS, st.booleans(), st.sampled_from([1, 4, 1 << 20]))
def test_bounded_matches_brute_force(spark, raws, enrs, first, width):
    # Enrichments at the same (key, arrival) would make "last" depend on
    # input order, which a table does not have: keep them unique.
    seen, unique = set(), []
    for key, a, v in enrs:
        if (key, a) not in seen:
            seen.add((key, a))
            unique.append((key, a, v))
    raw_df = spark.createDataFrame([(i, d, a) for i, (d, a) in enumerate(raws)], RAW_A)
    enr_df = spark.createDataFrame([(0, k, v, a) for k, a, v in unique], ENR_A)
    got = sorted(tuple(r) for r in enrich_arrival_bounded(raw_df, enr_df, "arrival", first,
                                                          width).collect())
    assert got == brute_force(raws, unique, first)


@settings(max_examples=4, deadline=None)
@given(RAWS, ENRS, st.booleans(), st.sampled_from([None, 2]))
def test_stream_matches_brute_force(spark, raws, enrs, first, groups):
    from rivulet.session import scratch_path
    from rivulet.streaming.arrival import enrich_stateful

    seen, unique = set(), []
    for key, a, v in enrs:
        if (key, a) not in seen:
            seen.add((key, a))
            unique.append((key, a, v))
    d = scratch_path(spark, "prop")
    spark.createDataFrame([(i, dt, a) for i, (dt, a) in enumerate(raws)], RAW_A) \
        .coalesce(1).write.parquet(f"{d}/raw")
    spark.createDataFrame([(0, k, v, a) for k, a, v in unique] or [(0, 0, None, 0)], ENR_A) \
        .where("key is not null" if unique else "false").coalesce(1).write.parquet(f"{d}/enr")
    raw = spark.readStream.schema(RAW_A).parquet(f"{d}/raw")
    enr = spark.readStream.schema(ENR_A).parquet(f"{d}/enr")
    out = enrich_stateful(raw, enr, arrival_col="arrival", enrichment_first_on_tie=first,
                          salt_buckets=3, key_groups=groups)
    q = (out.writeStream.format("parquet").option("path", f"{d}/out")
         .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{d}/out")
                 .select("event_time", "data", "enrichment").collect())
    assert got == brute_force(raws, unique, first)
