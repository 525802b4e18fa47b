"""Property test: lookup enrichment with last-write-wins (J1 + J2), every
join strategy, against a plain Python definition."""

from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.operators import enrich

DIM = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50),
                         st.one_of(st.none(), st.sampled_from(["p", "q", "r"]))), max_size=30)
RAW = st.lists(st.tuples(st.integers(-5, 10**6), st.one_of(st.none(), st.integers(0, 8))),
               min_size=1, max_size=30)


def _key(row):
    return tuple((v is None, v if v is not None else 0) if not isinstance(v, str)
                 else (False, v) for v in row)


def expected(raws, dim):
    latest = {}
    for seq, (key, ts, value) in enumerate(dim):
        if key not in latest or (ts, seq) > latest[key][0]:
            latest[key] = ((ts, seq), value)
    return sorted(((t, d, latest[d][1] if d in latest else None) for t, d in raws), key=_key)


@settings(max_examples=6, deadline=None)
@given(RAW, DIM, st.sampled_from(["broadcast", "shuffle", "salted", "bucketed"]))
def test_lookup_matches_python(spark, raws, dim, strategy):
    raw_df = spark.createDataFrame(raws, "event_time bigint, data int")
    dim_df = spark.createDataFrame([(ts, k, v, seq) for seq, (k, ts, v) in enumerate(dim)],
                                   "timestamp bigint, key int, enrichment string, seq bigint")
    out = enrich(raw_df, dim_df, order=("timestamp", "seq"), strategy=strategy,
                 salt_buckets=3, buckets=4)
    got = sorted(((r.event_time, r.data, r.enrichment) for r in out.collect()), key=_key)
    assert got == expected(raws, dim)
    assert all(r.key == f"{r.event_time}|{r.data}" for r in out.collect() if r.data is not None)
