"""Registered queries over peers, ports and clusters.

Peers are the suppliers (cluster: nation, load: line items), site and peer documents are
built per customer, attempts are line items.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from courier.config import ClientConfig
from courier.functions import urls as U
from courier.operators import routing as R
from courier.plans.inputs import table
from courier.plans.registry import query

PEERS_SQL = """
peers AS (
  SELECT n_name AS cluster,
    CASE WHEN s_acctbal < 3000 THEN 'https' ELSE 'http' END || '://s' || s_suppkey
      || '.peers.example' || CASE WHEN s_acctbal < 9000 THEN ':' || (8000 + s_nationkey) ELSE '' END
      || '/api?x=1' AS url,
    CASE WHEN s_acctbal < 5000 THEN CAST(10000 + s_nationkey AS INTEGER) END AS raw_port,
    s_acctbal < 3000 AS raw_is_secure,
    CAST(coalesce(load, 0) AS BIGINT) AS flow_file_count,
    CASE WHEN s_acctbal < 0 THEN -s_acctbal ELSE 0.0 END AS last_failure,
    s_acctbal, s_suppkey
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN (SELECT l_suppkey, count(*) // 100 AS load FROM lineitem GROUP BY 1)
    ON l_suppkey = s_suppkey)"""
PEER = "cluster, url, raw_port, raw_is_secure, flow_file_count, last_failure"
PREFERENCE = """CAST(trunc(last_failure * 1000) AS BIGINT), flow_file_count,
  regexp_extract(url, '^[a-z]+://([^:/]+)', 1),
  CAST(nullif(regexp_extract(url, '^[a-z]+://[^:/]+:([0-9]+)', 1), '') AS INTEGER) NULLS LAST, url"""


def peers(spark, sf_dir):
    load = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.expr("count(*) div 100").alias("load"))
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(load, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            F.col("n_name").alias("cluster"),
            F.concat(
                F.when(F.col("s_acctbal") < 3000, "https").otherwise("http"),
                F.lit("://s"),
                F.col("s_suppkey").cast("string"),
                F.lit(".peers.example"),
                F.when(
                    F.col("s_acctbal") < 9000,
                    F.concat(F.lit(":"), (F.col("s_nationkey") + 8000).cast("string")),
                ).otherwise(""),
                F.lit("/api?x=1"),
            ).alias("url"),
            F.when(F.col("s_acctbal") < 5000, (F.col("s_nationkey") + 10000).cast("int")).alias(
                "raw_port"
            ),
            (F.col("s_acctbal") < 3000).alias("raw_is_secure"),
            F.coalesce("load", F.lit(0)).cast("bigint").alias("flow_file_count"),
            F.when(F.col("s_acctbal") < 0, -F.col("s_acctbal")).otherwise(0.0).alias("last_failure"),
            "s_acctbal",
            "s_suppkey",
        )
    )


@query(
    "rank_peers",
    f"""WITH {PEERS_SQL} SELECT {PEER},
        row_number() OVER (PARTITION BY cluster ORDER BY {PREFERENCE}) AS rank FROM peers""",
)
def rank_peers(spark, sf_dir):
    return R.rank_peers(peers(spark, sf_dir).select(*R.PEER_COLUMNS))


@query(
    "preferred_peers",
    f"""WITH {PEERS_SQL} SELECT {PEER} FROM peers
        QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY {PREFERENCE}) = 1""",
)
def preferred_peers(spark, sf_dir):
    return R.preferred_peers(peers(spark, sf_dir).select(*R.PEER_COLUMNS))


@query(
    "record_failures",
    f"""WITH {PEERS_SQL},
      failed AS (SELECT l_suppkey, max(l_extendedprice) AS failed_at FROM lineitem
                 WHERE l_returnflag = 'R' GROUP BY 1)
      SELECT cluster, url, raw_port, raw_is_secure, flow_file_count,
        greatest(last_failure, coalesce(failed_at, last_failure)) AS last_failure
      FROM peers LEFT JOIN failed ON l_suppkey = s_suppkey""",
)
def record_failures(spark, sf_dir):
    all_peers = peers(spark, sf_dir)
    failures = (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .join(all_peers.select("url", "s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("url", F.col("l_extendedprice").alias("failed_at"))
    )
    return R.record_failures(all_peers.select(*R.PEER_COLUMNS), failures)


@query(
    "merge_peers",
    f"""WITH {PEERS_SQL},
      old AS (SELECT * FROM peers WHERE s_acctbal < 5000),
      fresh AS (SELECT cluster, url, CAST(NULL AS INTEGER) AS raw_port, FALSE AS raw_is_secure,
                  flow_file_count + 1 AS flow_file_count, 0.0 AS last_failure
                FROM peers WHERE s_acctbal > 2000 AND cluster <> 'NATION_3'),
      merged AS (
        SELECT cluster, url,
          CASE WHEN n.url IS NULL THEN o.raw_port ELSE n.raw_port END AS raw_port,
          coalesce(n.raw_is_secure, o.raw_is_secure) AS raw_is_secure,
          coalesce(n.flow_file_count, o.flow_file_count) AS flow_file_count,
          coalesce(o.last_failure, n.last_failure) AS last_failure
        FROM old o FULL JOIN fresh n USING (cluster, url)
        WHERE n.url IS NOT NULL OR (o.s_acctbal < 0 AND cluster <> 'NATION_3'))
      SELECT * FROM merged UNION ALL
      SELECT {PEER} FROM old WHERE cluster NOT IN (SELECT cluster FROM merged)""",
)
def merge_peers(spark, sf_dir):
    all_peers = peers(spark, sf_dir)
    listed = F.col("cluster") != "NATION_3"
    fresh = all_peers.where((F.col("s_acctbal") > 2000) & listed).select(
        "cluster",
        "url",
        F.lit(None).cast("int").alias("raw_port"),
        F.lit(False).alias("raw_is_secure"),
        (F.col("flow_file_count") + 1).alias("flow_file_count"),
        F.lit(0.0).alias("last_failure"),
    )
    old = all_peers.where("s_acctbal < 5000").select(*R.PEER_COLUMNS)
    initial = all_peers.where((F.col("s_acctbal") < 0) & listed).select("cluster", "url")
    return R.merge_peers(old, fresh, initial)


@query(
    "reset_peers",
    f"""WITH {PEERS_SQL}, known AS (SELECT * FROM peers WHERE s_acctbal < 0)
      SELECT {PEER} FROM known UNION ALL
      SELECT DISTINCT 'NATION_' || c_nationkey, 'http://' || c_mktsegment || '.example',
        CAST(NULL AS INTEGER), FALSE, CAST(0 AS BIGINT), 0.0 FROM customer
      WHERE 'NATION_' || c_nationkey NOT IN (SELECT cluster FROM known)""",
)
def reset_peers(spark, sf_dir):
    known = peers(spark, sf_dir).where("s_acctbal < 0").select(*R.PEER_COLUMNS)
    return R.reset_peers(known, _cluster_urls(spark, sf_dir))


def _cluster_urls(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("cluster"),
        F.concat(F.lit("http://"), F.col("c_mktsegment"), F.lit(".example")).alias("url"),
    )


@query(
    "cluster_urls",
    """SELECT DISTINCT 'NATION_' || c_nationkey AS cluster,
       'http://' || c_mktsegment || '.example' AS url FROM customer""",
)
def cluster_urls(spark, sf_dir):
    return R.distinct_cluster_urls(_cluster_urls(spark, sf_dir))


@query(
    "peer_urls",
    f"""WITH {PEERS_SQL} SELECT url, regexp_replace(url, '/api', '') AS base_url,
        regexp_extract(url, '^[a-z]+://([^:/]+)', 1) AS host,
        CAST(nullif(regexp_extract(url, '^[a-z]+://[^:/]+:([0-9]+)', 1), '') AS INTEGER) AS port,
        'raw://' || regexp_extract(url, '^[a-z]+://([^:/]+)', 1)
          || coalesce(':' || raw_port, '') || '/api?x=1' AS raw_url FROM peers""",
)
def peer_urls(spark, sf_dir):
    url = F.col("url")
    return peers(spark, sf_dir).select(
        "url",
        U.base_url(url).alias("base_url"),
        U.url_host(url).alias("host"),
        U.url_port(url).alias("port"),
        U.raw_url(url, F.col("raw_port"), "raw").alias("raw_url"),
    )


@query(
    "discover_raw_ports",
    f"""WITH {PEERS_SQL} SELECT url, coalesce(raw_port, CAST(20000 + s_suppkey AS INTEGER))
        AS raw_port FROM peers""",
)
def discover_raw_ports(spark, sf_dir):
    site = F.concat(
        F.lit('{"controller":{"remoteSiteListeningPort":'),
        (F.col("s_suppkey") + 20000).cast("string"),
        F.lit("}}"),
    )
    return peers(spark, sf_dir).select(
        "url", R.discover_raw_port(F.col("raw_port"), site).alias("raw_port")
    )


# --- documents ------------------------------------------------------------------------


@query(
    "parse_peers",
    """SELECT c_mktsegment AS cluster, CAST(0 AS INTEGER) AS position,
         CASE WHEN c_acctbal > 0 THEN 'https' ELSE 'http' END || '://' || c_name || ':8443' AS url,
         CAST(c_custkey AS BIGINT) AS flow_file_count FROM customer
       UNION ALL
       SELECT c_mktsegment, 2, 'http://second' || c_custkey, 0 FROM customer""",
)
def parse_peers(spark, sf_dir):
    body = F.format_string(
        '{"peers":[{"hostname":"%s","port":8443,"secure":%s,"flowFileCount":%d},'
        '{"port":1,"secure":true},{"hostname":"second%d"}]}',
        F.col("c_name"),
        (F.col("c_acctbal") > 0).cast("string"),
        F.col("c_custkey"),
        F.col("c_custkey"),
    )
    documents = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("cluster"), body.alias("body")
    )
    return R.parse_peers(documents).select("cluster", "position", "url", "flow_file_count")


def site_documents(spark, sf_dir):
    """One site document per customer: four ports, one of them broken, or a single one."""
    many = F.format_string(
        '{"controller":{"inputPorts":[{"id":"p%1$da","name":"orders"},{"name":"nameless"},'
        '{"id":"p%1$db","name":"orders"},{"id":"p%1$dc","name":"%2$s"}]}}',
        F.col("c_custkey"),
        F.col("c_mktsegment"),
    )
    single = F.format_string(
        '{"controller":{"inputPorts":[{"id":"p%dz","name":"only"}]}}', F.col("c_custkey")
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("cluster"),
        F.when(F.col("c_acctbal") < 0, single).otherwise(many).alias("body"),
    )


PORTS_SQL = """
ports AS (
  SELECT c_name AS cluster, 'only' AS name, 'p' || c_custkey || 'z' AS port_id
  FROM customer WHERE c_acctbal < 0 UNION ALL
  SELECT c_name, 'orders', 'p' || c_custkey || 'a' FROM customer WHERE c_acctbal >= 0 UNION ALL
  SELECT c_name, c_mktsegment, 'p' || c_custkey || 'c' FROM customer WHERE c_acctbal >= 0)"""


@query("parse_input_ports", f"WITH {PORTS_SQL} SELECT cluster, name, port_id FROM ports")
def parse_input_ports(spark, sf_dir):
    return R.parse_input_ports(site_documents(spark, sf_dir))


CANDIDATES_SQL = f"""
{PORTS_SQL},
wanted AS (SELECT c_name AS cluster,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'p' || c_custkey || 'a' END AS port_id,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'orders' END AS port_name FROM customer),
tried AS (
  SELECT cluster, port_id, 1 AS place FROM wanted WHERE port_id IS NOT NULL UNION ALL
  SELECT w.cluster, p.port_id, 2 FROM wanted w JOIN ports p
    ON p.cluster = w.cluster AND p.name = w.port_name UNION ALL
  SELECT cluster, min(port_id), 3 FROM ports GROUP BY cluster HAVING count(*) = 1),
candidates AS (
  SELECT cluster, port_id, CAST(row_number() OVER (PARTITION BY cluster ORDER BY min(place))
    AS INTEGER) AS rank FROM tried GROUP BY cluster, port_id)"""


def candidates(spark, sf_dir):
    clusters = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("cluster"),
        F.when(
            F.col("c_mktsegment") == "BUILDING",
            F.concat(F.lit("p"), F.col("c_custkey").cast("string"), F.lit("a")),
        ).alias("port_id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", "orders").alias("port_name"),
    )
    return R.port_candidates(
        clusters, R.parse_input_ports(site_documents(spark, sf_dir)), ClientConfig()
    )


@query("port_candidates", f"WITH {CANDIDATES_SQL} SELECT cluster, port_id, rank FROM candidates")
def port_candidates(spark, sf_dir):
    return candidates(spark, sf_dir)


@query(
    "configured_port",
    f"""WITH {PORTS_SQL},
      tried AS (SELECT DISTINCT cluster, 'main' AS port_id, 1 AS place FROM ports UNION ALL
        SELECT cluster, port_id, 2 FROM ports WHERE name = 'only' UNION ALL
        SELECT cluster, min(port_id), 3 FROM ports GROUP BY cluster HAVING count(*) = 1)
      SELECT cluster, port_id, CAST(row_number() OVER (PARTITION BY cluster ORDER BY min(place))
        AS INTEGER) AS rank FROM tried GROUP BY cluster, port_id""",
)
def configured_port(spark, sf_dir):
    clusters = table(spark, sf_dir, "customer").select(F.col("c_name").alias("cluster"))
    ports = R.parse_input_ports(site_documents(spark, sf_dir))
    return R.port_candidates(clusters, ports, ClientConfig(port_id="main", port_name="only"))


# --- failover -------------------------------------------------------------------------

#: A distinct sequence number for the line items of an order.
SEQ_SQL = "CAST(l_linenumber AS BIGINT) * 1000000000000000 + l_partkey * 10000000 + l_suppkey"


@query(
    "port_failover",
    f"""SELECT 'order-' || l_orderkey AS cluster, 'p' || arg_min(l_partkey, {SEQ_SQL}) AS port_id,
        min({SEQ_SQL}) AS rank FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey""",
)
def port_failover(spark, sf_dir):
    attempts = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("cluster"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("port_id"),
        F.expr(SEQ_SQL).alias("rank"),
        (F.col("l_returnflag") == "R").alias("accepted"),
    )
    return R.port_failover(attempts)


@query(
    "cluster_failover",
    f"""SELECT l_orderkey AS request_id, 'c' || arg_min(l_suppkey, {SEQ_SQL}) AS cluster,
        'tx-' || arg_min(l_partkey, {SEQ_SQL}) AS transaction_id
        FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey""",
)
def cluster_failover(spark, sf_dir):
    attempts = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("request_id"),
        F.concat(F.lit("c"), F.col("l_suppkey").cast("string")).alias("cluster"),
        F.expr(SEQ_SQL).alias("ordinal"),
        F.when(
            F.col("l_returnflag") == "A",
            F.concat(F.lit("tx-"), F.col("l_partkey").cast("string")),
        ).alias("transaction_id"),
    )
    return R.cluster_failover(attempts)


@query(
    "creation_failures",
    """SELECT c_name AS cluster, 'http://' || c_name AS url, 727056000.0::DOUBLE AS failed_at,
       TRUE AS refresh_peers FROM customer WHERE c_custkey IN
       (SELECT o_custkey FROM orders GROUP BY 1 HAVING NOT bool_or(o_orderstatus = 'F'))""",
)
def creation_failures(spark, sf_dir):
    people = table(spark, sf_dir, "customer")
    attempts = (
        table(spark, sf_dir, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_name").alias("cluster"), (F.col("o_orderstatus") == "F").alias("accepted"))
    )
    preferred = people.select(
        F.col("c_name").alias("cluster"), F.concat(F.lit("http://"), F.col("c_name")).alias("url")
    )
    return R.creation_failures(attempts, preferred, F.lit(727056000.0))


@query(
    "refresh_documents",
    """WITH a AS (SELECT c_mktsegment AS cluster, c_custkey AS position,
          'http://c' || c_custkey AS url, CASE WHEN c_custkey % 4 = 0
            THEN '{"peers":[{"hostname":"h' || c_custkey || '"}]}' ELSE 'busy' END AS body
        FROM customer)
      SELECT cluster, arg_min(url, position) AS url, arg_min(body, position) AS body
      FROM a WHERE body <> 'busy' GROUP BY cluster""",
)
def refresh_documents(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    listed = F.concat(F.lit('{"peers":[{"hostname":"h'), key, F.lit('"}]}'))
    replies = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("cluster"),
        F.col("c_custkey").alias("position"),
        F.concat(F.lit("http://c"), key).alias("url"),
        F.when(F.col("c_custkey") % 4 == 0, listed).otherwise("busy").alias("body"),
    )
    return R.refresh_documents(replies)
