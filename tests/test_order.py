"""Cut points, trims, running totals and drain plans against a row-by-row simulation."""

import random

import pytest
from pyspark.sql import functions as F

from courier.operators import drain, queue
from courier.operators.order import find_cut, running_totals
from tests import simulate

SMALL = {"finish_rows": 7, "take_rows": 0, "bins": 4}


def random_rows(seed, n=300, hot=False):
    """Rows with nulls, ties, zero sizes, negative priorities and, if ``hot``, one big tie."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        tie = hot and r.random() < 0.5
        rows.append(
            (
                i * 3 + 1,
                r.choice([None, 0, 1, 5, 40, 200]),
                1000 if tie else r.choice([None, r.randrange(-50, 50), r.randrange(10**12)]),
                r.choice([None, 10, 20, 30]),
                0 if tie else r.choice([None, -3, 0, 1, 2, 2**40]),
                r.choice([None, None, None, "tx-0"]),
            )
        )
    r.shuffle(rows)
    return rows


def ids(df):
    return sorted(r["packet_id"] for r in df.select("packet_id").collect())


@pytest.fixture(scope="module", params=[(1, False), (2, True)], ids=["mixed", "hot"])
def rows(request):
    return random_rows(*[request.param[0]], hot=request.param[1])


@pytest.mark.parametrize("limits", [(40, 0), (0, 1), (0, 900), (30, 700), (10**6, 10**9)])
def test_batch_by_search(queue_rows, rows, limits):
    df = queue_rows(rows).repartition(5).cache()
    assert ids(queue.batch(df, *limits, **SMALL)) == sorted(simulate.batch(rows, *limits))
    assert ids(queue.batch(df, *limits)) == sorted(simulate.batch(rows, *limits))


def test_batch_without_limits(queue_rows, rows):
    assert ids(queue.batch(queue_rows(rows), 0, 0)) == sorted(r[0] for r in rows if r[5] is None)


@pytest.mark.parametrize("limit", [0, 1, 150, 300])
def test_trim_rows(queue_rows, rows, limit):
    df = queue_rows(rows).repartition(5)
    assert ids(queue.trim_rows(df, limit, **SMALL)) == sorted(simulate.trim_rows(rows, limit))


@pytest.mark.parametrize("limit", [0, 1, 300, 5000, 10**9])
def test_trim_bytes(queue_rows, rows, limit):
    df = queue_rows(rows).repartition(5)
    assert ids(queue.trim_bytes(df, limit, **SMALL)) == sorted(simulate.trim_bytes(rows, limit))


def test_trim_bytes_at_exactly_the_total_keeps_empty_packets(queue_rows):
    df = queue_rows([(1, 5, 0, 0, 0, None), (2, None, 0, 0, 0, None)])
    assert ids(queue.trim_bytes(df, 5)) == [1, 2]
    assert ids(queue.trim_bytes(df, 4)) == [1]


def test_no_limit_keeps_all(queue_rows):
    df = queue_rows([(1, 5, 0, 0, 0, None)])
    assert ids(queue.trim_rows(df, None)) == [1]
    assert ids(queue.trim_bytes(df, None)) == [1]
    assert find_cut(df) is None


def test_cut_over_the_whole_long_range(queue_rows):
    ends = [-(2**63), -1, 0, 2**63 - 1]
    rows = [(i, 10, c, 0, p, None) for i, (p, c) in enumerate((p, c) for p in ends for c in ends)]
    df = queue_rows(rows)
    for n in (1, 4, 9, 16):
        kept = ids(queue.trim_rows(df, n, finish_rows=1, take_rows=0, bins=3))
        assert kept == sorted(simulate.trim_rows(rows, n))


def test_rows_that_tie_completely_are_taken_together(queue_rows):
    df = queue_rows([(1, 5, 0, 0, 0, None)] * 4)
    assert queue.trim_rows(df, 2, finish_rows=1, take_rows=0, bins=2).count() == 4


def test_empty_queue(queue_rows):
    df = queue_rows([])
    assert ids(queue.batch(df, 5, 10)) == []
    assert ids(queue.batch(df, 0, 10)) == []
    assert ids(queue.trim_rows(df, 3, take_rows=0)) == []
    assert drain.drain_plan(df, 3, 10).count() == 0


# --- running totals --------------------------------------------------------------


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("chunk_rows", [11, 10**6])
def test_running_totals_of_groups(spark, reverse, chunk_rows):
    r = random.Random(5)
    rows = []
    for i in range(400):
        group = "hot" if i % 3 else r.choice(["a", "b", None, f"g{r.randrange(40)}"])
        rows.append((group, r.randrange(20), i, r.randrange(9)))
    df = spark.createDataFrame(rows, "g string, k int, id int, v int").repartition(6)
    found = running_totals(
        df, group=["g"], order=["k", "id"], total="v", reverse=reverse, chunk_rows=chunk_rows
    ).collect()
    if chunk_rows == 11:
        assert len({f["chunk"] for f in found}) > 10
    expected = {}
    for group in {g for g, *_ in rows}:
        mine = sorted((x for x in rows if x[0] == group), key=lambda x: x[1:3], reverse=reverse)
        total = 0
        for number, (_, _, i, v) in enumerate(mine, 1):
            total += v
            expected[i] = (number, total)
    assert {f["id"]: (f["row_number"], f["running_total"]) for f in found} == expected


def test_running_totals_of_everything(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v")).repartition(5)
    found = running_totals(df, order=["id"], total="v", chunk_rows=50).collect()
    total = 0
    expected = {}
    for i in range(1000):
        total += i % 7
        expected[i] = (i + 1, total)
    assert {f["id"]: (f["row_number"], f["running_total"]) for f in found} == expected


# --- drain plans ---------------------------------------------------------------------


@pytest.mark.parametrize("chunk_rows", [13, 10**6])
@pytest.mark.parametrize(
    "limits", [(7, 0), (0, 100), (5, 300), (3, 10**6), (0, 9000), (1, 1)]
)
def test_drain_plan(queue_rows, rows, limits, chunk_rows):
    df = queue_rows(rows).repartition(5)
    found = drain.drain_plan(df, *limits, chunk_rows=chunk_rows).collect()
    assert {f["packet_id"]: f["batch"] for f in found} == simulate.drain(rows, *limits)


@pytest.mark.parametrize("limits", [(60, 250), (0, 9000), (0, 10**9)])
def test_drain_plan_in_levels(queue_rows, rows, limits):
    df = queue_rows(rows).repartition(5)
    found = drain.drain_plan(df, *limits, chunk_rows=9, fan=2).collect()
    assert {f["packet_id"]: f["batch"] for f in found} == simulate.drain(rows, *limits)


@pytest.mark.parametrize("limits", [(20, 10**9), (10**9, 200), (23, 230), (7, 1000)])
def test_drain_plan_of_equal_packets_with_batches_as_large_as_chunks(queue_rows, limits):
    rows = [(i, 10, i, None, 0, None) for i in range(200)]
    df = queue_rows(rows)
    found = drain.drain_plan(df, *limits, chunk_rows=20, fan=3).collect()
    assert {f["packet_id"]: f["batch"] for f in found} == simulate.drain(rows, *limits)


def test_drain_without_limits_is_one_batch(queue_rows):
    df = queue_rows(random_rows(9, n=20))
    assert {r["batch"] for r in drain.drain_plan(df, 0, None).collect()} == {1}
