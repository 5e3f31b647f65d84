"""Peer ranking, refresh, ports and failover."""

import json

import pytest
from pyspark.sql import functions as F

from courier.config import ClientConfig
from courier.functions import urls as U
from courier.operators import routing as R
from courier.schema import PEER_SCHEMA


@pytest.fixture()
def peers(spark):
    def build(*rows):
        full = [(c, url, None, False, count, failure) for c, url, count, failure in rows]
        return spark.createDataFrame(full, PEER_SCHEMA)

    return build


def ranked(df, **options):
    rows = R.rank_peers(df, **options).orderBy("cluster", "rank").collect()
    return [r["url"] for r in rows]


@pytest.mark.parametrize(
    "first, second",
    [
        (("c", "http://z:9", 9, 1.0), ("c", "http://a:1", 0, 1.002)),  # earlier failure
        (("c", "http://z:9", 1, 1.0001), ("c", "http://a:1", 2, 1.0009)),  # same ms: load
        (("c", "http://a:9", 1, 0.0), ("c", "http://b:1", 1, 0.0)),  # host
        (("c", "http://a:1", 1, 0.0), ("c", "http://a:2", 1, 0.0)),  # port
        (("c", "http://a:90", 1, 0.0), ("c", "http://a:100", 1, 0.0)),  # port as a number
        (("c", "http://a:1", 1, 0.0), ("c", "http://a", 1, 0.0)),  # missing port last
        (("c", "http://z:1", 1, 0.0), ("c", "file:///x", 1, 0.0)),  # missing host last
    ],
)
def test_peer_order(peers, first, second):
    for rows in ((first, second), (second, first)):
        df = peers(*rows)
        assert ranked(df) == [first[1], second[1]]
        assert [r["url"] for r in R.preferred_peers(df).collect()] == [first[1]]


def test_ranks_of_a_split_cluster(peers):
    rows = [("hot" if i % 3 else f"c{i % 5}", f"http://h{i:03d}", i % 4, 0.0) for i in range(90)]
    assert ranked(peers(*rows), chunk_rows=7) == ranked(peers(*rows))


def test_failures(spark, peers):
    failures = spark.createDataFrame(
        [("http://a", 5.0), ("http://a", 7.0), ("http://b", 1.0)], "url string, failed_at double"
    )
    df = R.record_failures(
        peers(("c", "http://a", 0, 6.0), ("c", "http://b", 0, 3.0), ("c", "http://d", 0, 2.0)), failures
    )
    assert {r["url"]: r["last_failure"] for r in df.collect()} == {
        "http://a": 7.0, "http://b": 3.0, "http://d": 2.0,
    }


def test_merge(spark, peers):
    old = peers(("c", "u1", 5, 9.0), ("c", "u2", 5, 8.0), ("c", "u3", 5, 7.0), ("d", "v", 1, 1.0))
    new = peers(("c", "u1", 1, 0.0), ("c", "u9", 2, 0.0))
    initial = spark.createDataFrame([("c", "u2")], "cluster string, url string")
    merged = R.merge_peers(old, new, initial).collect()
    assert sorted((r["cluster"], r["url"], r["flow_file_count"], r["last_failure"]) for r in merged) == [
        ("c", "u1", 1, 9.0),  # new load, old failure
        ("c", "u2", 5, 8.0),  # configured initially
        ("c", "u9", 2, 0.0),
        ("d", "v", 1, 1.0),  # nothing came for d, so it keeps its list
    ]


def test_a_url_listed_twice_counts_by_its_later_entry(spark):
    body = json.dumps({"peers": [
        {"hostname": "h", "port": 1, "flowFileCount": 5}, {"port": 2},
        {"hostname": "h", "port": 1, "flowFileCount": 7}, {"hostname": "s", "secure": True}]})
    docs = spark.createDataFrame([("c", body), ("bad", "{")], "cluster string, body string")
    parsed = R.parse_peers(docs)
    assert [(r["position"], r["url"], r["flow_file_count"]) for r in parsed.collect()] == [
        (0, "http://h:1", 5), (2, "http://h:1", 7), (3, "https://s", 0),
    ]
    none = spark.createDataFrame([], PEER_SCHEMA)
    merged = R.merge_peers(none, parsed, parsed.limit(0)).collect()
    assert sorted((r["url"], r["flow_file_count"]) for r in merged) == [("http://h:1", 7), ("https://s", 0)]


def test_reset_and_distinct_urls(spark, peers):
    clusters = spark.createDataFrame(
        [("c", "u"), ("d", "v"), ("d", "v"), ("d", "w")], "cluster string, url string"
    )
    assert R.distinct_cluster_urls(clusters).count() == 3
    reset = R.reset_peers(peers(("c", "x", 1, 1.0)), clusters).collect()
    assert sorted((r["cluster"], r["url"]) for r in reset) == [("c", "x"), ("d", "v"), ("d", "w")]


def site(*ports):
    return json.dumps({"controller": {"remoteSiteListeningPort": 10443, "inputPorts": list(ports)}})


def test_ports(spark):
    docs = spark.createDataFrame(
        [
            ("two", site({"id": "1", "name": "a"}, {"id": "2", "name": "a"}, {"id": "3"}, {"id": "4", "name": "b"})),
            ("one", site({"id": "9", "name": "z"})),
            ("none", "{}"),
        ],
        "cluster string, body string",
    )
    ports = R.parse_input_ports(docs)
    assert sorted(tuple(r) for r in ports.collect()) == [
        ("one", "z", "9"), ("two", "a", "1"), ("two", "b", "4"),
    ]

    def candidates(config):
        rows = R.port_candidates(docs.select("cluster"), ports, config).collect()
        return sorted((r["cluster"], r["rank"], r["port_id"]) for r in rows)

    assert candidates(ClientConfig()) == [("one", 1, "9")]
    assert candidates(ClientConfig(port_name="a")) == [("one", 1, "9"), ("two", 1, "1")]
    assert candidates(ClientConfig(port_id="1", port_name="a")) == [
        ("none", 1, "1"), ("one", 1, "1"), ("one", 2, "9"), ("two", 1, "1"),
    ]
    assert candidates(ClientConfig(port_id="9", port_name="z")) == [
        ("none", 1, "9"), ("one", 1, "9"), ("two", 1, "9"),
    ]
    raw = docs.select(
        R.discover_raw_port(F.lit(None).cast("int"), F.col("body")).alias("found"),
        R.discover_raw_port(F.lit(5), F.col("body")).alias("known"),
    )
    assert [tuple(r) for r in raw.collect()] == [(10443, 5), (10443, 5), (None, 5)]


def test_failover(spark, peers):
    attempts = spark.createDataFrame(
        [("c", "p1", 1, False), ("c", "p2", 2, True), ("c", "p3", 3, True), ("d", "q", 1, False)],
        "cluster string, port_id string, rank int, accepted boolean",
    )
    assert [tuple(r) for r in R.port_failover(attempts).collect()] == [("c", "p2", 2)]
    requests = spark.createDataFrame(
        [(1, "a", 0, None), (1, "b", 1, "t1"), (1, "c", 2, "t2"), (2, "a", 0, None)],
        "request_id int, cluster string, ordinal int, transaction_id string",
    )
    assert [tuple(r) for r in R.cluster_failover(requests).collect()] == [(1, "b", "t1")]
    failed = R.creation_failures(attempts, peers(("c", "u", 0, 0.0), ("d", "v", 0, 0.0)), F.lit(3.0))
    assert [tuple(r) for r in failed.collect()] == [("d", "v", 3.0, True)]


def test_urls(spark):
    df = spark.createDataFrame([("https://h.x:8443/a/b?q=1#f",), ("http://h",), ("http://me:pw@h:1/a",)], "u string")
    rows = df.select(
        U.base_url(F.col("u")), U.url_host(F.col("u")), U.url_port(F.col("u")),
        U.raw_url(F.col("u"), F.lit(99), "raw"), U.last_segment(F.lit("http://h/t/abc")),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("https://h.x:8443?q=1#f", "h.x", 8443, "raw://h.x:99/a/b?q=1#f", "abc"),
        ("http://h", "h", None, "raw://h:99", "abc"),
        ("http://me:pw@h:1", "h", 1, "raw://me:pw@h:99/a", "abc"),
    ]


def test_refresh_documents(spark):
    good, empty = '{"peers":[{"hostname":"n"}]}', '{"peers":[]}'
    replies = spark.createDataFrame(
        [("c", 0, "u0", None), ("c", 1, "u1", "x"), ("c", 2, "u2", good), ("c", 3, "u3", empty),
         ("d", 0, "v0", empty), ("e", 0, "w0", "{}")],
        "cluster string, position int, url string, body string",
    )
    rows = R.refresh_documents(replies).orderBy("cluster").collect()
    assert [tuple(r) for r in rows] == [("c", "u2", good), ("d", "v0", empty)]
