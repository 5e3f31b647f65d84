"""What the plans must not do: move payloads, read idle columns, or use one task for all."""

import re

import pytest
from pyspark.sql import functions as F

from courier.operators import outcomes, queue
from courier.operators.order import Cut
from courier.operators.transfer import _parsed
from courier.schema import QUEUE_SCHEMA


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A queue in a Parquet file."""
    rows = [
        (i, f'{{"k":"{i}"}}', b"payload", 20, i % 50, 10**6, i % 3, "t" if i % 10 == 0 else None)
        for i in range(1000)
    ]
    path = str(tmp_path_factory.mktemp("stored") / "queue")
    spark.createDataFrame(rows, QUEUE_SCHEMA).write.parquet(path)
    return spark.read.schema(QUEUE_SCHEMA).parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "change",
    [
        lambda q: queue.batch(q, 100, 4096),
        lambda q: queue.assign(q, "t2", 100, 4096),
        lambda q: queue.trim_rows(q, 500),
        lambda q: queue.trim_bytes(q, 5000),
        lambda q: queue.age_off(q, 5),
        lambda q: queue.acknowledge(q, "t"),
        lambda q: queue.release(q, "t"),
    ],
)
def test_state_changes_move_no_rows(stored, change):
    text = plan(change(stored))
    assert "Exchange" not in text and "Window" not in text and "Python" not in text


def test_cuts_reach_the_scan(stored):
    text = plan(queue.batch(stored, 100, 0))
    pushed = re.search(r"PushedFilters: \[(.*)", text).group(1)
    assert "IsNull(transaction_id)" in pushed and "LessThanOrEqual(priority" in pushed


def test_filters_reach_the_scan(stored):
    assert "EqualTo(transaction_id,t)" in plan(queue.transaction_packets(stored, "t"))
    assert "GreaterThanOrEqual(expires,5)" in plan(queue.age_off(stored, 5))


def test_a_search_reads_only_sort_columns(spark, stored, monkeypatch):
    """Neither payloads nor attributes are read to find a cut."""
    read = []
    original = type(stored).collect

    def watch(df):
        read.append(plan(df))
        return original(df)

    monkeypatch.setattr(type(stored), "collect", watch)
    queue.batch_cut(stored, 0, 500, finish_rows=10, take_rows=0, bins=8)
    assert len(read) > 2
    for text in read:
        for schema in re.findall(r"ReadSchema: struct<(.*?)>", text):
            assert "content" not in schema and "attributes" not in schema


def test_status_is_one_partial_aggregate(stored):
    from courier.config import QueueConfig

    text = plan(queue.queue_status(stored, QueueConfig()))
    assert "partial_count" in text and re.search(r"ReadSchema: struct<estimated_size:bigint>", text)


def test_waiting_packets_stay_out_of_the_outcome_join(spark, stored):
    done = spark.createDataFrame([("t", "TRANSACTION_COMPLETED")], "transaction_id string, state string")
    text = outcomes.apply_outcomes(stored, done)._jdf.queryExecution().optimizedPlan().toString()
    union, join = text.split("Join", 1)
    assert "Union" in union and "isnotnull(transaction_id" in join.lower()


def test_frames_parse_attributes_once(stored):
    from courier.functions.frames import frame, frame_length

    both = _parsed(stored).select(
        frame_length(F.col("attributes"), F.col("content")), F.crc32(frame(F.col("attributes"), F.col("content")))
    )
    assert plan(both).lower().count("from_json") <= 2  # one projection, named once per branch


def test_cut_with_nulls_in_its_key(spark):
    rows = [(None, None, 1), (None, 5, 2), (0, None, 3), (0, 4, 4), (1, 0, 5)]
    df = spark.createDataFrame(rows, "priority bigint, created bigint, packet_id bigint")
    columns = ("priority", "created", "packet_id")
    for n, row in enumerate(rows, 1):
        kept = df.where(Cut(columns, row).inside()).collect()
        assert sorted(r["packet_id"] for r in kept) == list(range(1, n + 1))
        assert df.where(~Cut(columns, row).inside()).count() == len(rows) - n
