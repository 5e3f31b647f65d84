"""Peers, input ports and clusters: which one takes the next transaction?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courier.config import ClientConfig
from courier.functions.urls import peer_url, url_host, url_port
from courier.operators.order import CHUNK_ROWS, running_totals

_PEERS_JSON = (
    "peers array<struct<hostname:string,port:int,secure:boolean,flowFileCount:bigint>>"
)
_SITE_JSON = (
    "controller struct<remoteSiteListeningPort:int,inputPorts:array<struct<id:string,name:string>>>"
)
PEER_COLUMNS = ("cluster", "url", "raw_port", "raw_is_secure", "flow_file_count", "last_failure")


# --- peers -----------------------------------------------------------------------


def parse_peers(documents: DataFrame) -> DataFrame:
    """Peers of ``documents (cluster, body)``.

    Entries without a host name are skipped; the count defaults to 0.  ``position`` is
    the entry's place in its document.
    """
    parsed = F.from_json("body", _PEERS_JSON)["peers"]
    listed = documents.select("cluster", F.posexplode(parsed).alias("position", "peer"))
    return listed.where(F.col("peer.hostname").isNotNull()).select(
        "cluster",
        "position",
        peer_url(F.col("peer.hostname"), F.col("peer.port"), F.col("peer.secure")).alias("url"),
        F.lit(None).cast("int").alias("raw_port"),
        F.lit(False).alias("raw_is_secure"),
        F.coalesce("peer.flowFileCount", F.lit(0)).cast("bigint").alias("flow_file_count"),
        F.lit(0.0).alias("last_failure"),
    )


def refresh_documents(replies: DataFrame) -> DataFrame:
    """The document each cluster refreshes its peers from: ``cluster, url, body``.

    ``replies (cluster, position, url, body)`` are the answers of a cluster's peers in the
    order in which they are asked; the first that holds a list of peers is taken, an empty
    list too.  A cluster without such an answer gives no row, and keeps the peers it has.
    """
    listed = F.from_json("body", _PEERS_JSON)["peers"].isNotNull()
    first = F.min_by(F.struct("url", "body"), F.struct("position", "url"))
    return (
        replies.where(listed)
        .groupBy("cluster")
        .agg(first.alias("first"))
        .select("cluster", "first.url", "first.body")
    )


def _preference(peers: DataFrame) -> tuple[DataFrame, list[str]]:
    """Peers with their comparison columns: failure time, load, host, port, missing last."""
    host, port = url_host(F.col("url")), url_port(F.col("url"))
    compared = (
        peers.withColumn("_failed", (F.col("last_failure") * F.lit(1000)).cast("bigint"))
        .withColumn("_host", host)
        .withColumn("_no_host", host.isNull())
        .withColumn("_port", port)
        .withColumn("_no_port", port.isNull())
    )
    return compared, [
        "_failed", "flow_file_count", "_no_host", "_host", "_no_port", "_port", "url",
    ]


def rank_peers(peers: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Peers with their ``rank`` inside the cluster, best first.

    A cluster may hold any share of the peers: ranking splits it over tasks.
    """
    compared, keys = _preference(peers)
    ranked = running_totals(compared, group=["cluster"], order=keys, chunk_rows=chunk_rows)
    return ranked.select(*peers.columns, F.col("row_number").alias("rank"))


def preferred_peers(peers: DataFrame) -> DataFrame:
    """The best peer of every cluster."""
    compared, keys = _preference(peers)
    best = F.min_by(F.struct(*peers.columns), F.struct(*keys)).alias("peer")
    return compared.groupBy("cluster").agg(best).select("peer.*")


def record_failures(peers: DataFrame, failures: DataFrame) -> DataFrame:
    """Peers with ``failures (url, failed_at)`` folded in; the URL alone is the key."""
    latest = failures.groupBy("url").agg(F.max("failed_at").alias("_failed_at"))
    return (
        peers.join(latest, "url", "left")
        .withColumn("last_failure", F.greatest("last_failure", F.col("_failed_at")))
        .select(*peers.columns)
    )


def merge_peers(old: DataFrame, new: DataFrame, initial: DataFrame) -> DataFrame:
    """A refreshed peer list.

    New peers replace old ones but keep their failure time; old ones that are gone stay
    only if configured initially (``initial (cluster, url)``); a cluster left without any
    keeps its old list.  Of a URL listed twice in ``new`` the later entry counts.
    """
    key = ["cluster", "url"]
    fields = [c for c in PEER_COLUMNS if c not in key]
    place = F.col("position") if "position" in new.columns else F.lit(0)
    fresh = (
        new.withColumn("_place", place)
        .groupBy(*key)
        .agg(F.max_by(F.struct(*fields), "_place").alias("new"))
    )
    known = old.select(*key, F.struct(*fields).alias("old"))
    configured = initial.select(*key).distinct().withColumn("_initial", F.lit(True))
    both = (
        known.join(fresh, key, "full_outer")
        .join(configured, key, "left")
        .where(F.col("new").isNotNull() | F.col("_initial"))
    )
    chosen = [
        F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
        for c in fields
        if c != "last_failure"
    ]
    failed = F.coalesce("old.last_failure", "new.last_failure").alias("last_failure")
    merged = both.select(*key, *chosen, failed).select(*PEER_COLUMNS)
    left_empty = old.join(merged.select("cluster").distinct(), "cluster", "left_anti")
    return merged.unionByName(left_empty.select(*PEER_COLUMNS))


def reset_peers(peers: DataFrame, clusters: DataFrame) -> DataFrame:
    """Peers, plus the configured URLs of clusters that have no peer."""
    empty = distinct_cluster_urls(clusters).join(
        peers.select("cluster").distinct(), "cluster", "left_anti"
    )
    initial = empty.select(
        "cluster",
        "url",
        F.lit(None).cast("int").alias("raw_port"),
        F.lit(False).alias("raw_is_secure"),
        F.lit(0).cast("bigint").alias("flow_file_count"),
        F.lit(0.0).alias("last_failure"),
    )
    return peers.select(*PEER_COLUMNS).unionByName(initial)


def distinct_cluster_urls(clusters: DataFrame) -> DataFrame:
    return clusters.dropDuplicates(["cluster", "url"])


# --- ports -------------------------------------------------------------------------


def parse_input_ports(documents: DataFrame) -> DataFrame:
    """``cluster, name, port_id`` of ``documents (cluster, body)``.

    Entries without an id or a name are skipped; the first of a repeated name counts.
    """
    ports = F.from_json("body", _SITE_JSON)["controller"]["inputPorts"]
    listed = documents.select("cluster", F.posexplode(ports).alias("position", "port"))
    usable = listed.where(F.col("port.id").isNotNull() & F.col("port.name").isNotNull())
    return usable.groupBy("cluster", F.col("port.name").alias("name")).agg(
        F.min_by("port.id", "position").alias("port_id")
    )


def discover_raw_port(raw_port: Column, site_document: Column) -> Column:
    """The known raw port, else the one the site document states."""
    stated = F.get_json_object(site_document, "$.controller.remoteSiteListeningPort")
    return F.coalesce(raw_port, stated.try_cast("int"))


def port_candidates(clusters: DataFrame, ports: DataFrame, config: ClientConfig) -> DataFrame:
    """``cluster, port_id, rank``: ports to try, in order.

    First the configured id, then the id of the configured name, then the only port of a
    cluster that has exactly one.  An id appears once, at its best rank.  ``clusters``
    gives the cluster names; it may carry its own ``port_id`` and ``port_name``.
    """
    own = set(clusters.columns)
    wanted = clusters.select(
        "cluster",
        (F.col("port_id") if "port_id" in own else F.lit(config.port_id)).cast("string").alias("_id"),
        (F.col("port_name") if "port_name" in own else F.lit(config.port_name))
        .cast("string").alias("_name"),
    ).dropDuplicates(["cluster"])
    by_id = wanted.where(F.col("_id").isNotNull()).select(
        "cluster", F.col("_id").alias("port_id"), F.lit(1).alias("_order")
    )
    by_name = ports.join(
        wanted.select("cluster", F.col("_name").alias("name")), ["cluster", "name"]
    ).select("cluster", "port_id", F.lit(2).alias("_order"))
    sole = (
        ports.groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), F.min("port_id").alias("port_id"))
        .where("n = 1")
        .join(wanted.select("cluster"), "cluster", "left_semi")
        .select("cluster", "port_id", F.lit(3).alias("_order"))
    )
    best = (
        by_id.unionByName(by_name)
        .unionByName(sole)
        .groupBy("cluster", "port_id")
        .agg(F.min("_order").alias("_order"))
    )
    # At most three candidates per cluster, so the ranking array stays that short.
    ranked = best.groupBy("cluster").agg(
        F.array_sort(F.collect_list(F.struct("_order", "port_id"))).alias("found")
    )
    return ranked.select("cluster", F.posexplode("found").alias("position", "port")).select(
        "cluster", F.col("port.port_id").alias("port_id"), (F.col("position") + 1).alias("rank")
    )


# --- failover ------------------------------------------------------------------------


def port_failover(attempts: DataFrame) -> DataFrame:
    """Per cluster, the first accepted port of ``attempts (cluster, port_id, rank, accepted)``."""
    return (
        attempts.where(F.col("accepted"))
        .groupBy("cluster")
        .agg(F.min_by("port_id", "rank").alias("port_id"), F.min("rank").alias("rank"))
    )


def cluster_failover(attempts: DataFrame) -> DataFrame:
    """Per request, the first cluster in configured order that gave a transaction.

    ``attempts (request_id, cluster, ordinal, transaction_id)``; no transaction is null.
    """
    won = F.min_by(F.struct("cluster", "transaction_id"), "ordinal").alias("won")
    return (
        attempts.where(F.col("transaction_id").isNotNull())
        .groupBy("request_id")
        .agg(won)
        .select("request_id", "won.cluster", "won.transaction_id")
    )


def creation_failures(attempts: DataFrame, preferred: DataFrame, failed_at: Column) -> DataFrame:
    """Failure events for the preferred peer of clusters where no attempt was accepted.

    ``record_failures`` folds them in; every such cluster needs a peer refresh.
    """
    failed = (
        attempts.groupBy("cluster")
        .agg(F.bool_or(F.coalesce("accepted", F.lit(False))).alias("_any"))
        .where(~F.col("_any"))
        .select("cluster")
    )
    return preferred.join(failed, "cluster").select(
        "cluster", "url", failed_at.alias("failed_at"), F.lit(True).alias("refresh_peers")
    )
