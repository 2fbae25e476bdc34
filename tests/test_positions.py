import pytest
from pyspark.sql import functions as F

from shardlog.operators.checkpoint import (
    advance,
    checkpoint,
    drop_rare_replays,
    drop_replays,
    progress,
    resume,
)
from shardlog.operators.positions import (
    from_latest,
    read_from_positions,
    read_log_from_latest,
    read_log_from_positions,
    start_at,
)
from shardlog.schema import AT_TIMESTAMP, SHARD_GROUPS
from shardlog.sources.log import append_sync, in_shard_order, scan, scan_groups, select_shards
from tests.util import (
    BIG,
    checkpoints,
    numbers,
    plan_of,
    position,
    positions,
    record,
    records,
)

LOG = [record("a", n, at=i) for i, n in enumerate(["8", "9", "10", "11", BIG[:-1], BIG])]
LOG += [record("b", n, at=i) for i, n in enumerate(["5", "50", "500"])]
LOG += [record("c", "7", at=100)]


def test_each_shard_starts_at_its_own_position(spark):
    start = positions(
        spark,
        [
            position("a", "AFTER_SEQUENCE_NUMBER", "9"),
            position("b", "AT_SEQUENCE_NUMBER", "50"),
            position("c", AT_TIMESTAMP, at=100),
            position("empty", "TRIM_HORIZON"),
        ],
    )
    got = numbers(read_from_positions(records(spark, LOG), start))
    assert got == sorted(
        [("a", n) for n in ["10", "11", BIG[:-1], BIG]] + [("b", "50"), ("b", "500"), ("c", "7")]
    )


def test_shards_without_position_are_not_read(spark):
    start = positions(spark, [position("b", "TRIM_HORIZON")])
    got = numbers(read_from_positions(records(spark, LOG), start))
    assert {shard for shard, _ in got} == {"b"}


def test_latest_reads_behind_marks_and_unknown_shards_whole(spark):
    marks = checkpoints(spark, [("a", "11"), ("b", "500")])
    got = numbers(from_latest(records(spark, LOG), marks))
    assert got == [("a", BIG[:-1]), ("a", BIG), ("c", "7")]


def test_latest_among_other_positions(spark):
    start = positions(spark, [position(s, "LATEST") for s in "abc"])
    marks = checkpoints(spark, [("a", BIG[:-1]), ("b", "50")])
    got = numbers(read_from_positions(records(spark, LOG), start, marks))
    assert got == [("a", BIG), ("b", "500"), ("c", "7")]


def test_positions_that_lack_something_are_errors(spark):
    start = positions(spark, [position("a", "LATEST")])
    bad = [start]
    bad += [positions(spark, [position("a", p)]) for p in ("AT_SEQUENCE_NUMBER", AT_TIMESTAMP, "X")]
    for start in bad:
        with pytest.raises(Exception, match="cannot start at position"):
            read_from_positions(records(spark, LOG), start).collect()


def test_single_start_positions(spark):
    a = select_shards(records(spark, LOG), "s", ["a"])
    names = ["8", "9", "10", "11", BIG[:-1], BIG]

    def got(**how):
        return {n for _, n in numbers(start_at(a, **how))}

    assert got(position=2) == set(names)
    assert got(position=0, sequence_number="10") == set(names[2:])
    assert got(position=1, sequence_number="10") == set(names[3:])
    assert got(position="AT_SEQUENCE_NUMBER", sequence_number=BIG) == {BIG}
    assert got(position=3, marks=checkpoints(spark, [("a", "9")])) == set(names[2:])
    # A start time overrides the position that is given with it.
    assert got(position=2, start_time=F.lit("2024-01-01 00:00:04").cast("timestamp")) == set(names[4:])
    for bad in ({"position": 9}, {"position": 0}, {"position": "LATEST"}):
        with pytest.raises(ValueError):
            got(**bad)


def test_stream_must_be_named(spark):
    with pytest.raises(ValueError, match="A stream must be specified"):
        select_shards(records(spark, LOG), "")


def test_checkpoint_orders_by_length_first_and_ignores_empty_numbers(spark):
    rows = LOG + [record("d", ""), record("e", None), record("b", "")]
    got = {(r.shard_id, r.sequence_number, r.sequence_len) for r in checkpoint(records(spark, rows)).collect()}
    assert got == {("a", BIG, 56), ("b", "500", 3), ("c", "7", 1)}


def test_progress_counts_all_and_checkpoints_what_has_a_number(spark):
    rows = LOG + [record("d", ""), record("e", None), record("b", "")]
    got = {(r.shard_id, r.n_messages, r.checkpoint) for r in progress(records(spark, rows)).collect()}
    assert got == {("a", 6, BIG), ("b", 4, "500"), ("c", 1, "7"), ("d", 1, None), ("e", 1, None)}


def test_advance_never_goes_back(spark):
    old = checkpoints(spark, [("a", "10"), ("b", "99")])
    new = checkpoints(spark, [("a", "9"), ("b", "100"), ("c", "1")])
    assert numbers(advance(old, new)) == [("a", "10"), ("b", "100"), ("c", "1")]


def test_resume(spark):
    start = positions(
        spark,
        [
            position("a", "LATEST"),
            position("b", "AT_SEQUENCE_NUMBER", "50"),
            position("c", AT_TIMESTAMP, at=101),
        ],
    )
    saved = checkpoints(spark, [("a", BIG[:-1])])
    again = resume(records(spark, LOG), start, saved)
    assert numbers(again) == [("a", BIG[:-1]), ("a", BIG), ("b", "50"), ("b", "500")]
    later = resume(records(spark, LOG), start, saved, inclusive=False)
    assert numbers(later) == [("a", BIG), ("b", "50"), ("b", "500")]


def test_drop_replays(spark):
    twice = records(spark, LOG + LOG[2:5] + [LOG[0]] * 3)
    assert numbers(drop_replays(twice)) == numbers(records(spark, LOG))
    assert numbers(drop_rare_replays(twice)) == numbers(records(spark, LOG))
    unnumbered = records(spark, [record("a", None), record("a", None), record("b", ""), record("b", "")])
    for drop in (drop_replays, drop_rare_replays):
        assert drop(twice.unionByName(unnumbered)).count() == len(LOG) + 4


def test_log_reads_prune_shards_and_push_bounds(spark, tmp_path):
    path = str(tmp_path / "log")
    append_sync(records(spark, LOG), path, partitions=3)
    assert numbers(scan(spark, path)) == numbers(records(spark, LOG))
    start = positions(
        spark,
        [
            position("a", "AT_SEQUENCE_NUMBER", "10"),
            position("b", "TRIM_HORIZON"),
            position("c", AT_TIMESTAMP, at=100),
        ],
    )
    read = read_log_from_positions(spark, path, start)
    want = numbers(read_from_positions(records(spark, LOG), start))
    assert numbers(read) == want
    plan = plan_of(read)
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any("GreaterThan(sequence_len,2)" in line or "GreaterThanOrEqual(sequence_len" in line for line in pushed)
    assert any("GreaterThanOrEqual(arrival_ts" in line for line in pushed)
    pruned = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert all("dynamicpruning" in line for line in pruned if "ReadSchema" not in line) and len(pruned) >= 3


def test_many_shards_prune_and_push_alike(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [record(f"shard {s}", str(n), at=n) for s in range(80) for n in range(5, 15)]
    append_sync(records(spark, rows), path, partitions=4)
    start = [position(f"shard {s}", "AT_SEQUENCE_NUMBER", "12") for s in range(40)]
    read = read_log_from_positions(spark, path, positions(spark, start))
    assert read.count() == 40 * 3
    plan = plan_of(read)
    assert "dynamicpruning" in plan and "GreaterThan" in plan
    assert numbers(read_from_positions(records(spark, rows), positions(spark, start))) == numbers(read)


def test_many_shards_share_few_folders(spark, tmp_path):
    """Files are bounded by tasks and folders, not by shards, and stay sorted, so a shard's read is pruned."""
    path = str(tmp_path / "log")
    rows = [record(f"shard {s}", str(n), at=n) for s in range(1000) for n in range(5, 8)]
    append_sync(records(spark, rows), path, partitions=4)
    files = list((tmp_path / "log").rglob("part-*.parquet"))
    assert len(files) <= 4 + SHARD_GROUPS
    for file in files:
        keys = [(r.shard_id, r.sequence_len, r.sequence_number) for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)
    start = positions(spark, [position(f"shard {s}", "AFTER_SEQUENCE_NUMBER", "5") for s in range(1000)])
    assert read_log_from_positions(spark, path, start).count() == 2000
    one = select_shards(scan_groups(spark, path), "s", ["shard 7"])
    assert sorted(r.sequence_number for r in one.collect()) == ["5", "6", "7"]
    assert len({f.rsplit("/", 2)[1] for f in one.inputFiles()}) == SHARD_GROUPS
    assert one.select(F.input_file_name()).distinct().count() == 1 and "shard_group" in plan_of(one)


def test_one_position_a_shard(spark):
    start = positions(spark, [position("a", "TRIM_HORIZON"), position("a", "AT_SEQUENCE_NUMBER", "9")])
    with pytest.raises(ValueError, match="more than one position"):
        read_from_positions(records(spark, LOG), start)


def test_checkpoint_without_lengths(spark):
    rows = records(spark, LOG).withColumn("sequence_len", F.lit(None).cast("int"))
    assert numbers(checkpoint(rows)) == [("a", BIG), ("b", "500"), ("c", "7")]


def test_batches_of_several_writers_and_a_batch_run_twice(spark, tmp_path):
    path = str(tmp_path / "log")
    append_sync(records(spark, LOG[:4]), path, writer="w", batch_id=1)
    append_sync(records(spark, LOG[4:7]), path, writer="w", batch_id=2)
    append_sync(records(spark, LOG[4:7]), path, writer="w", batch_id=2)
    append_sync(records(spark, LOG[7:]), path)
    assert numbers(scan(spark, path)) == numbers(records(spark, LOG))


def test_copies_and_hot_shards_are_spread_in_order(spark):
    copies = spark.range(4000, numPartitions=8).select(
        F.lit("s").alias("stream"),
        F.lit("a").alias("shard_id"),
        F.lit("7").alias("sequence_number"),
        F.lit(1).alias("sequence_len"),
    )
    spread = in_shard_order(copies, 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 and sum(r["count"] for r in spread) == 4000
    hot = copies.withColumn("sequence_number", F.monotonically_increasing_id().cast("string"))
    hot = hot.withColumn("sequence_len", F.length("sequence_number"))
    parts = (
        in_shard_order(hot, 4)
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(
            F.min(F.struct("sequence_len", "sequence_number")).alias("lo"),
            F.max(F.struct("sequence_len", "sequence_number")).alias("hi"),
        )
        .orderBy("p")
        .collect()
    )
    assert len(parts) == 4 and all(a.hi < b.lo for a, b in zip(parts, parts[1:]))


def test_latest_on_a_stored_log_is_bounded(spark, tmp_path):
    """Shards with a mark are read behind it, those without are found by name and read whole."""
    path = str(tmp_path / "log")
    rows = [record(shard, str(n)) for shard in "abc" for n in range(30)]
    append_sync(records(spark, rows), path)
    found = read_log_from_latest(spark, path, checkpoints(spark, [("a", "12"), ("b", "29"), ("gone", "5")]))
    assert numbers(found) == sorted([("a", str(n)) for n in range(13, 30)] + [("c", str(n)) for n in range(30)])
    plan = plan_of(found)
    assert "GreaterThanOrEqual(sequence_number,5)" in plan and plan.count("dynamicpruning") >= 2
    assert numbers(read_log_from_latest(spark, path, checkpoints(spark, []))) == numbers(records(spark, rows))
