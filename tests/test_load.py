"""Gate, guard, upsert and the other load operators."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from reelhouse.functions.times import ntz
from reelhouse.operators import load
from reelhouse.operators.load import (
    AmbiguousUpsert,
    by_repeats,
    incremental_gate,
    latest_of_repeated,
    latest_per_key,
    merge_into_table,
    upsert,
)

SCHEMA = "k string, v int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def merged(spark, target, source):
    return bag(upsert(table(spark, target), table(spark, source), "k"))


def test_upsert_replaces_inserts_and_keeps(spark):
    result = merged(spark, [("a", 1), ("b", 2)], [("b", 20), ("c", 30)])
    assert result == Counter([("a", 1), ("b", 20), ("c", 30)])


def test_upsert_null_keys_never_match(spark):
    result = merged(spark, [(None, 1), ("a", 1)], [(None, 2), (None, 3)])
    assert result == Counter([(None, 1), ("a", 1), (None, 2), (None, 3)])


def test_upsert_takes_nulls_from_the_source(spark):
    assert merged(spark, [("a", 1)], [("a", None)]) == Counter([("a", None)])


def test_upsert_matches_columns_by_name(spark):
    source = spark.createDataFrame([(5, "a")], "v int, k string")
    result = upsert(table(spark, [("a", 1)]), source, "k")
    assert result.columns == ["k", "v"] and bag(result) == Counter([("a", 5)])


def test_upsert_into_and_from_empty(spark):
    assert merged(spark, [], [("a", 1), ("a", 2)]) == Counter([("a", 1), ("a", 2)])
    assert merged(spark, [("a", 1)], []) == Counter([("a", 1)])


def test_two_source_rows_for_one_target_row_are_an_error(spark):
    with pytest.raises(AmbiguousUpsert, match="2 source rows for k = 'a'"):
        merged(spark, [("a", 1), ("b", 2)], [("a", 3), ("a", 4), ("b", 5)])


def test_repeated_new_keys_are_all_inserted(spark):
    result = merged(spark, [("a", 1)], [("n", 3), ("n", 3), ("n", 4)])
    assert result == Counter([("a", 1), ("n", 3), ("n", 3), ("n", 4)])


@pytest.mark.parametrize("piece", [10_000, 3])
def test_every_copy_of_a_target_row_is_updated(spark, monkeypatch, piece):
    monkeypatch.setattr(load, "COPIES_PER_PIECE", piece)
    target = [("a", i) for i in range(10)] + [("b", 0)] * 3 + [("c", 0), ("d", 1)]
    result = merged(spark, target, [("a", 77), ("b", 88), ("c", 99)])
    assert result == Counter({("a", 77): 10, ("b", 88): 3, ("c", 99): 1, ("d", 1): 1})


def test_upsert_is_idempotent(spark):
    keys = st.sampled_from(["a", "b", "c", "d", None])

    @settings(max_examples=8, deadline=None)
    @given(
        st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12),
        st.dictionaries(st.sampled_from(["a", "b", "x", "y"]), st.integers(10, 19)),
    )
    def check(target, source):
        once = upsert(table(spark, target), table(spark, list(source.items())), "k")
        twice = upsert(once, table(spark, list(source.items())), "k")
        expected = Counter((k, source.get(k, v)) for k, v in target)
        expected.update((k, v) for k, v in source.items() if k not in dict(target))
        assert bag(once) == bag(twice) == expected

    check()


def gate(spark, target_stamps, run, strict=False):
    target = spark.createDataFrame([(s,) for s in target_stamps], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("reference_date")
    )
    return incremental_gate(spark.range(5), target, ntz(run), strict=strict).count()


def test_gate_is_all_or_nothing(spark):
    stamps = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", None]
    assert gate(spark, stamps, "2024-01-02 00:00:01") == 5
    assert gate(spark, stamps, "2024-01-02 00:00:00") == 0
    assert gate(spark, stamps, "2024-01-01 12:00:00") == 0


def test_gate_with_empty_target(spark):
    assert gate(spark, [], "2024-01-02 00:00:00") == 5
    assert gate(spark, [], "2024-01-02 00:00:00", strict=True) == 0


def test_gate_defaults_to_the_current_time(spark):
    target = spark.range(1).select(F.lit("2020-01-01").cast("timestamp").alias("reference_date"))
    assert incremental_gate(spark.range(5), target).count() == 5


def test_latest_per_key(spark):
    rows = [("a", 1, 5), ("a", 2, 1), ("a", 2, 1), ("b", 9, 9), (None, 1, 1), (None, 2, 2)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    expected = [("a", 2, 1), ("b", 9, 9), (None, 1, 1), (None, 2, 2)]
    assert bag(latest_per_key(df, "k", ["t"])) == Counter(expected)


def test_merge_into_needs_a_table_format_with_row_level_changes(spark):
    spark.sql("DROP TABLE IF EXISTS plain_parquet")
    spark.sql("CREATE TABLE plain_parquet (k string, v int) USING PARQUET")
    try:
        with pytest.raises(UnsupportedOperationException, match="MERGE INTO"):
            merge_into_table(table(spark, [("a", 1)]), "plain_parquet", "k")
    finally:
        spark.sql("DROP TABLE plain_parquet")


@pytest.mark.parametrize("bound", ["-1", "10mb"])
def test_rows_with_a_key_of_their_own_pass_by(spark, conf, bound):
    conf(autoBroadcastJoinThreshold=bound)
    rows = [("a", 1), ("b", 2), ("b", 3), ("b", 3), (None, 4), (None, 4), ("c", None)]
    df = table(spark, rows)
    want = [("a", 1), ("b", 3), (None, 4), (None, 4), ("c", None)]
    assert bag(latest_of_repeated(df, "k", ["v"])) == bag(latest_per_key(df, "k", ["v"])) == Counter(want)
    once, rest = by_repeats(df, "k")
    if bound == "-1":
        assert once is None and bag(rest) == Counter(rows)
    else:
        assert bag(once) == Counter([("a", 1), ("c", None)])
        assert "hashpartitioning" not in once._jdf.queryExecution().executedPlan().toString()
    assert bag(latest_of_repeated(table(spark, []), "k", [])) == Counter()
