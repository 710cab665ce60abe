import pytest
from pyspark.sql import functions as F

from tillpanel.operators import membership
from tillpanel.operators.membership import possible_members, told_apart


@pytest.mark.parametrize("words", [1, 64, membership.WORDS])
def test_no_member_is_lost_and_few_others_pass(spark, monkeypatch, words):
    monkeypatch.setattr(membership, "WORDS", words)
    frame = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("key"), F.lit("x").alias("member_word"))
    members = spark.range(0, 20_000, 100).select(F.when(F.col("id") > 0, F.col("id")).alias("wanted"))
    found = possible_members(frame, F.col("key"), members, F.col("wanted"))
    assert found.columns == frame.columns
    kept = {r.key for r in found.collect()}
    assert {None, *range(100, 20_000, 100)} <= kept
    if words > 64:
        assert len(kept) < 250


def test_no_members(spark):
    frame = spark.range(10).select(F.col("id").alias("key"))
    assert possible_members(frame, F.col("key"), frame.filter("false"), F.col("key")).count() == 0


def test_rows_that_repeat_stay(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("key"))
    assert possible_members(frame, F.col("key"), spark.range(1).toDF("k"), F.col("k")).count() == 50


@pytest.mark.parametrize("words", [1, membership.WORDS])
def test_told_apart_loses_and_repeats_no_row(spark, monkeypatch, words):
    monkeypatch.setattr(membership, "WORDS", words)
    frame = spark.range(3_000).select(F.when(F.col("id") > 0, F.col("id") % 1_000).alias("key"))
    members = spark.range(0, 1_000, 50).select(F.col("id").alias("k"))
    found, others = ([r.key for r in part.collect()] for part in told_apart(frame, F.col("key"), members, F.col("k")))
    assert set(range(0, 1_000, 50)) <= set(found) and not set(range(0, 1_000, 50)) & set(others)
    assert sorted(str(r.key) for r in frame.collect()) == sorted(map(str, found + others))
    if words > 1:
        assert len(others) > 2_500
