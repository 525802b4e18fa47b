"""Exact dedup by block naming against grouping whole texts on the driver."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rivulet.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, kept int, `key` string, identity long"


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    members = defaultdict(list)
    for (i, _), t in zip(rows, norm):
        members[t].append(i)
    out = []
    for (i, _), t in zip(rows, norm):
        least = min((x for x in members[t] if x is not None), default=None)
        out.append((i, least, len(members[t]), hashlib.sha256(t.encode()).hexdigest()))
    return out


def check(spark, rows, **opts):
    df = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in rows], SCHEMA).repartition(3)
    got = exact_dedup(df, **opts).collect()

    def by(r):
        return tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=by) \
        == sorted(brute(rows), key=by)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})  # one a group
    assert all(r.doc_id == r.keep_id for r in kept)


def texts():
    rng = random.Random(3)
    base = ["", " ", "a", "a b", "ä" * 700, "x" * 1024, "x" * 1025, "x" * 2048, "x" * 2049,
            " ".join(f"w{i % 83}" for i in range(60_000))]
    base += [base[-1][:-1] + "!", base[-1] + " ", base[-1] + "\n\t"]
    base += ["".join(rng.choice("ab ") for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t) for i, t in enumerate(base) if i % 2]
    rows += [(3, "a b"), (3, "a \t b"), (None, "a b"), (None, None), (None, None), (200, None),
             (None, "only null ids"), (None, "only null ids")]
    return rows


@pytest.mark.parametrize("opts", [{}, {"block": 7}, {"block": 3, "hash_bits": 4}])
def test_groups(spark, opts):
    rows = texts()
    if "block" in opts:
        rows = [(i, t) for i, t in rows if len(t or "") < 3000]
    check(spark, rows, **opts)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(df).count() == 0
    assert exact_dedup(df).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_a_third_of_all_rows_alike(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("copy " * 800)).otherwise(
            F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup(df)
    assert got.filter("group_size = 1000").count() == 1000
    assert got.filter("kept").count() == 2001


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = exact_dedup(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
