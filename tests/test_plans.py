"""The physical plans: pushed filters, pruned columns, hot keys, no Python."""

import re

import pytest
from pyspark.sql import functions as F

from reelhouse import session
from reelhouse.operators import joins
from reelhouse.operators.joins import join_unique
from reelhouse.operators.load import AmbiguousUpsert, upsert
from reelhouse.plans import trusted as T
from reelhouse.plans.stage import STAGE_MODELS
from reelhouse.session import (
    clear_scratch,
    estimated_bytes,
    scratch_dir,
    scratch_root,
    sized_shuffles,
)
from reelhouse.workload import views

WINDOW = ("2024-01-15 07:00:00", "2024-01-15 12:00:00")


def plan(df):
    return df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def final_plan(df):
    """The plan after adaptive execution has run it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stage(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stage")
    tables = {}
    for name, landing in views.landing_views(spark, "/root/testdata/sf0.01").items():
        STAGE_MODELS[name].build(landing).write.parquet(f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
    return tables


TIMES = {"start_at", "end_at", "start_ts", "end_ts"}


def read_rows(df):
    """Rows that came out of each scan of a query that has run."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().get("numOutputRows").get().value())
        inner = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            inner.append(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            inner.append(node.plan())
        todo += inner
    return found


def scanned(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*)>", text)]


def test_window_pushes_title_and_days(stage):
    text = plan(T.users_in_window(stage["streams"], "red bolt #7", *WINDOW))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(movie_title,red bolt #7)" in pushed
    assert "GreaterThanOrEqual(start_ts,1705302000)" in pushed
    assert "LessThanOrEqual(end_ts,1705320000)" in pushed
    assert "Or(IsNull(start_ts),IsNull(end_ts))" in pushed
    assert scanned(text) == [TIMES | {"movie_title", "user_email"}]


def test_row_groups_of_other_days_are_skipped(spark, tmp_path):
    """A whole month in one file of several row groups; one day is asked for."""
    text = F.concat(F.lit("2024-01-"), F.lpad((F.col("id") / 2000 + 1).cast("int").cast("string"), 2, "0"))
    sessions = spark.range(0, 60_000, 1, 1).select(
        F.col("id").cast("string").alias("movie_title"),
        F.lit("u").alias("user_email"),
        F.lit(1.0).alias("size_mb"),
        F.concat(text, F.lit("T10:00:00Z")).alias("start_at"),
        F.concat(text, F.lit("T11:00:00Z")).alias("end_at"),
    )
    staged = STAGE_MODELS["streams"].build(sessions).sortWithinPartitions("start_ts")
    staged.write.option("parquet.block.size", 1 << 18).parquet(str(tmp_path / "s"))
    asked = T.users_in_window(spark.read.parquet(str(tmp_path / "s")), None, *WINDOW)
    assert asked.collect() == [(1,)]
    (rows,) = read_rows(asked)
    assert 0 < rows < 30_000


def test_past_half_pushes_the_day_and_prunes_columns(stage):
    text = plan(T.users_past_half(stage["streams"], stage["movies"], "2024-01-23 23:59:59"))
    assert "Or(IsNull(start_ts),IsNull(end_ts))" in text
    assert {"movie_title", "half_minutes"} in scanned(text)
    assert TIMES | {"movie_title", "user_email"} in scanned(text)
    assert "BroadcastHashJoin" in text


def test_median_and_mean_read_only_their_columns(stage):
    assert set(map(frozenset, scanned(plan(T.median_size_gb(stage["streams"]))))) == {frozenset({"size_mb"})}
    assert scanned(plan(T.mean_session_hours(stage["streams"]))) == [TIMES]


def test_origin_reads_titles_and_a_settled_side(stage):
    text = plan(
        T.adaptations_by_author_origin(
            stage["streams"], stage["reviews"], stage["books"], stage["authors"], "nation_20"
        )
    )
    assert {"movie", "written"} in scanned(text) and {"movie_title"} in scanned(text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_nested_columns_are_pruned(spark, tmp_path):
    landing = views.landing_view("reviews", views.tables(spark, "/root/testdata/sf0.001"))
    landing.write.parquet(str(tmp_path / "r"))
    staged = STAGE_MODELS["reviews"].build(spark.read.parquet(str(tmp_path / "r")))
    (columns,) = scanned(plan(staged.select("book_title")))
    assert columns == {"books", "metadata", "title"}


def test_no_python_in_any_plan(stage):
    assert "Broadcast" not in plan(T.adaptation_share(stage["streams"], stage["reviews"]))
    plans = [
        plan(T.users_past_half(stage["streams"], stage["movies"], WINDOW[0])),
        plan(T.adaptation_share(stage["streams"], stage["reviews"])),
        plan(STAGE_MODELS["users"].build(stage["users"])),
    ]
    for text in plans:
        assert "Python" not in text and "Pandas" not in text


@pytest.fixture
def shuffled(conf):
    """No broadcasts, and partitions of a few kilobytes count as large."""
    conf(
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="16",
        adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__coalescePartitions__minPartitionSize="1KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """200,000 rows, a third of them with one key and another sixth without any."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 6 == 0, None)
        .when(F.col("id") % 3 == 1, "hot")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
        .alias("k"),
        F.col("id").alias("v"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_a_hot_key_is_split_against_a_unique_side(spark, hot, shuffled, how):
    right = hot.filter("k is not null").select("k").distinct()
    joined = join_unique(hot, right, "k", how)
    text = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in text
    nulls = hot.filter("k is null").count()
    assert joined.count() == (nulls if how == "left_anti" else hot.count() - nulls)


def arrivals(spark):
    return spark.range(20_000).select(
        F.concat(F.lit("n"), F.col("id")).alias("k"), F.col("id").alias("v")
    )


def test_a_large_upsert_splits_a_hot_target_key(spark, hot, shuffled):
    """The session allows no broadcast, so there is none."""
    merged = upsert(hot, arrivals(spark), "k")
    text = final_plan(merged)
    assert "SortMergeJoin(skew=true)" in text and "Broadcast" not in text
    assert merged.count() == 220_000


def test_rows_without_a_key_are_not_shuffled_by_an_upsert(spark, hot, shuffled):
    text = final_plan(upsert(hot, arrivals(spark), "k"))
    assert "isnotnull(k" in text and "isnull(k" in text
    assert re.search(r"Union", text)


def test_a_small_upsert_does_not_shuffle_the_target(spark, hot, shuffled):
    merged = upsert(hot, arrivals(spark), "k", broadcast_bytes=2**24)
    assert "SortMergeJoin" not in final_plan(merged)
    assert merged.count() == 220_000


def test_the_source_of_an_upsert_is_computed_once(spark):
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    source = arrivals(spark).mapInArrow(count, "k string, v long")
    upsert(arrivals(spark), source, "k").count()
    assert counted.value == 20_000


@pytest.mark.parametrize("bound", [0, 2**40])
def test_both_ways_of_an_upsert_agree(spark, conf, bound):
    conf(autoBroadcastJoinThreshold=str(min(bound, 2**30)))
    target = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "k string, v int"
    )
    source = spark.createDataFrame([("a", 9), ("c", 8), (None, 7), ("n", 6), ("n", 6)], "k string, v int")
    rows = sorted((tuple(r) for r in upsert(target, source, "k").collect()), key=repr)
    expected = [("a", 9)] * 3 + [("b", 3), ("c", 8), ("n", 6), ("n", 6), (None, 4), (None, 7)]
    assert rows == sorted(expected, key=repr)
    with pytest.raises(AmbiguousUpsert):
        upsert(target, source.unionAll(source.filter("k = 'c'")), "k")


@pytest.mark.parametrize("bound", [0, 2**40])
def test_both_ways_of_a_dimension_join_agree(stage, conf, bound):
    conf(autoBroadcastJoinThreshold=str(min(bound, 2**30)))
    answer = T.users_past_half(stage["streams"], stage["movies"], "2024-01-23 23:59:59", True)
    assert tuple(answer.first()) == (150, 1124)


def test_broadcast_bounds_are_the_sessions(spark, conf):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "k string, v int")
    assert df.agg(F.sum(joins.row_bytes(df))).first()[0] == 2 + 2 * (8 + joins.ROW_OVERHEAD_BYTES)
    for text, bound in (("-1", -1), ("0", 0), ("10MB", 10 << 20), ("256k", 256 << 10), ("7b", 7)):
        conf(autoBroadcastJoinThreshold=text)
        assert joins.broadcast_bound(df) == bound


def test_sized_shuffles(spark, conf):
    conf(
        shuffle__partitions="300",
        adaptive__coalescePartitions__initialPartitionNum="8",
        adaptive__advisoryPartitionSizeInBytes="64MB",
    )
    names = ["coalescePartitions.initialPartitionNum", "advisoryPartitionSizeInBytes"]

    def now():
        return [spark.conf.get(f"spark.sql.adaptive.{n}") for n in names]

    for size, partitions in ((10 * 2**40, 81920), (1, 300), (2**60, 1_000_000)):
        with sized_shuffles(spark, size) as got:
            assert got == partitions and now() == [str(partitions), str(128 * 2**20)]
        assert now() == ["8", "64MB"]
    with pytest.raises(ZeroDivisionError), sized_shuffles(spark, 1):
        raise ZeroDivisionError
    assert now() == ["8", "64MB"]


def test_input_sizes_are_those_of_the_files(spark, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "r"))
    files = sum(f.stat().st_size for f in (tmp_path / "r").glob("*.parquet"))
    assert files <= estimated_bytes(spark.read.parquet(str(tmp_path / "r"))) <= 2 * files


def test_scratch_folders_are_new_and_shared(spark):
    first, second = scratch_dir(spark), scratch_dir(spark)
    shared = spark.conf.get("spark.checkpoint.dir")
    assert first != second and first.startswith(shared) and second.startswith(shared)


def test_scratch_folders_can_be_cleared(spark, tmp_path, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(f"{scratch_root(spark)}/") and scratch_root(spark).startswith(f"{shared}/")
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "own"))
    assert not clear_scratch(spark)
    spark.range(3).write.parquet(scratch_dir(spark))
    (tmp_path / "other").mkdir()
    assert clear_scratch(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]
