"""Folds and label encoders: invariants and errors."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ticketlens.operators import folds as fo
from ticketlens.operators import labels as lb
from ticketlens.plans import views as V


def test_folds_match_plain_global_order(spark, sf_dir):
    folded = V.order_folds(spark, sf_dir).select("id", "stratum", "fold").collect()
    rows = sorted(folded, key=lambda r: (r.stratum, hashlib.md5(f"42:{r.id}".encode()).hexdigest(), r.id))
    expected = {r.id: i % 5 + 1 for i, r in enumerate(rows)}
    assert {r.id: r.fold for r in folded} == expected


def test_folds_balanced_per_stratum(spark, sf_dir):
    folded = V.order_folds(spark, sf_dir)
    counts = folded.groupBy("stratum", "fold").count().collect()
    per = {}
    for r in counts:
        per.setdefault(r.stratum, []).append(r["count"])
    for sizes in per.values():
        assert max(sizes) - min(sizes) <= 1
    totals = [r["count"] for r in folded.groupBy("fold").count().collect()]
    assert max(totals) - min(totals) <= 1 and sum(totals) == folded.count()


def test_stratum_key_errors(spark):
    df = spark.createDataFrame([("a", None)], "queue string, priority string")
    with pytest.raises(ValueError):
        fo.stratum_key(df, [])
    with pytest.raises(KeyError, match="columns to stratify by are absent: lang"):
        fo.stratum_key(df, ["queue", "lang"])
    got = df.select(fo.stratum_key(df, ["queue", "priority"]).alias("k")).first().k
    assert got == "a__|____missing__"


def test_small_strata_guard(spark):
    df = spark.createDataFrame([(i, "x" if i < 8 else "y") for i in range(10)], "id long, c string")
    with pytest.raises(ValueError, match="less than 5 rows"):
        fo.check_strata(df, "c", 5)
    fo.check_strata(df, "c", 2)


def test_ordered_codes_and_unknown(spark):
    df = spark.createDataFrame([("low",), ("medium",), ("high",)], "priority string")
    codes = [r.label_id for r in lb.encode_ordered(df, "priority", ("low", "medium", "high")).collect()]
    assert codes == [0, 1, 2]
    bad = spark.createDataFrame([("low",), ("urgent",), ("critical",)], "priority string")
    with pytest.raises(ValueError, match="critical, urgent"):
        lb.check_known_labels(bad, "priority", ("low", "medium", "high"))


def test_alphabetical_codes_and_weights(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("b",), (None,)], "q string")
    codes = {r.q: r.label_id for r in lb.encode_alphabetical(df.where(F.col("q").isNotNull()), "q").collect()}
    assert codes == {"a": 0, "b": 1, "c": 2}
    w = {r.label: r.weight for r in lb.balanced_weights(df, "q").collect()}
    assert w["b"] == pytest.approx(5 / (3 * 3)) and w["a"] == pytest.approx(5 / 3)


def test_guards_fire_inside_the_query(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3] if i else "rare") for i in range(31)], "id long, c string")
    folded = fo.stratified_folds(df, "id", "c", n_splits=5)  # no job yet
    with pytest.raises(Exception, match="strata with less than 5 rows: rare"):
        folded.collect()
    kept = fo.stratified_folds(df, "id", "c", n_splits=5, small="keep").collect()
    assert len(kept) == 31 and {r.fold for r in kept} == {1, 2, 3, 4, 5}
    assert fo.stratified_folds(df.where("c <> 'rare'"), "id", "c", n_splits=5).count() == 30

    bad = spark.createDataFrame([("low",), ("worse",), ("odd",), (None,)], "p string")
    coded = lb.encode_ordered(bad, "p", ("low", "high"))
    with pytest.raises(Exception, match="labels not in the given order: odd, worse"):
        coded.collect()
    assert [r.label_id for r in lb.encode_ordered(bad, "p", ("low", "high"), unknown="null").collect()] == [0, None, None, None]
    assert [r.label_id for r in lb.encode_ordered(bad.where("p = 'low' or p is null"), "p", ("low", "high")).collect()] == [0, None]


def test_folds_do_not_depend_on_the_buckets(spark, monkeypatch):
    df = spark.createDataFrame([(i if i % 9 else None, "ab"[i % 2]) for i in range(300)], "id long, c string")
    found = []
    for n in (1, 7, 256):
        monkeypatch.setattr(fo, "LEAST_BUCKETS", n)
        out = fo.stratified_folds(df, "id", "c")
        found.append(sorted(map(repr, out.collect())))
        assert out.count() == 300  # rows without an id are dealt too
    assert found[0] == found[1] == found[2]
