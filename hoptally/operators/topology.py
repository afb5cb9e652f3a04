"""Nodes of the delivery tree, what feeds them, and where messages are lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptally.functions.model import BUCKETS, health, is_loss, percentile_columns, received
from hoptally.sources.files import settled

#: Tiers and the tier below each, and how parent and child belong together.
CHAIN = [("AGENT", "PUBLISHER", "host"), ("VIP", "AGENT", "cluster"), ("COLLECTOR", "VIP", "cluster"), ("HDFS", "COLLECTOR", "cluster"), ("LOCAL", "HDFS", "cluster"), ("MERGE", "LOCAL", "source"), ("MIRROR", "MERGE", "source")]


def topic_counts(tuples: DataFrame) -> DataFrame:
    """Counts by node (name, cluster, tier), topic and host. Nodes above the collectors carry the cluster's name."""
    name = F.when(F.upper("tier").isin("PUBLISHER", "AGENT", "COLLECTOR"), F.col("hostname")).otherwise(F.col("cluster"))
    sums = [F.sum(F.coalesce(b, F.lit(0))).cast("long").alias(b) for b in BUCKETS]
    rows = tuples.withColumn("name", name).groupBy("name", "cluster", "tier", "topic", "hostname").agg(F.sum("sent").alias("sent"), *sums)
    return rows.withColumn("received", received())


def topology_nodes(tuples: DataFrame, percentiles: list[float]) -> DataFrame:
    """A row a node: received, sent, topics, percentiles, and stats: an array of (topic, received, sent) without hosts."""
    per_topic = topic_counts(tuples).groupBy("name", "cluster", "tier", "topic").agg(*(F.sum(x).alias(x) for x in ("received", "sent", *BUCKETS)))
    nodes = per_topic.groupBy("name", "cluster", "tier").agg(
        *(F.sum(x).alias(x) for x in ("received", "sent", *BUCKETS)), F.count("*").alias("topics"), F.array_sort(F.collect_list(F.struct("topic", "received", "sent"))).alias("stats")
    )
    return nodes.select("name", "cluster", "tier", "received", "sent", "topics", *percentile_columns(percentiles), "stats")


def topic_percentiles(tuples: DataFrame, percentiles: list[float]) -> DataFrame:
    per_topic = topic_counts(tuples).groupBy("name", "cluster", "tier", "topic").agg(*(F.sum(x).alias(x) for x in ("received", "sent", *BUCKETS)))
    return per_topic.select("name", "cluster", "tier", "topic", "received", "sent", *percentile_columns(percentiles))


def vip_nodes(tuples: DataFrame) -> DataFrame:
    """One node VIP a cluster: the sum of its collectors; topics that differ in case are one."""
    rows = topic_counts(tuples).where("upper(tier) = 'COLLECTOR'").groupBy("cluster", F.lower("topic").alias("topic")).agg(F.sum("received").alias("received"), F.sum("sent").alias("sent"))
    nodes = rows.groupBy("cluster").agg(F.sum("received").alias("received"), F.sum("sent").alias("sent"), F.count("*").alias("topics"))
    return nodes.select(F.lit("VIP").alias("name"), "cluster", F.lit("VIP").alias("tier"), "received", "sent", "topics")


def source_clusters(source: DataFrame, dest: DataFrame) -> DataFrame:
    """tier, cluster, source. A merge cluster is fed by all clusters that send any of its primary streams, a mirror by all
    clusters that are primary for any of its mirrored streams."""
    primary = dest.where("is_primary").select("stream", F.col("cluster").alias("node"))
    merge = primary.join(source.where("enabled"), "stream").select(F.lit("MERGE").alias("tier"), F.col("node").alias("cluster"), F.col("cluster").alias("source"))
    mirrored = dest.where("not is_primary").select("stream", "cluster")
    mirror = mirrored.join(primary, "stream").select(F.lit("MIRROR").alias("tier"), "cluster", F.col("node").alias("source"))
    return merge.unionByName(mirror).distinct()


def _nodes(tuples: DataFrame) -> DataFrame:
    """name, cluster, tier, topic, hostname, received, sent: a row a node, topic and host, with the VIP nodes."""
    counts = settled(topic_counts(tuples)).select("name", "cluster", F.upper("tier").alias("tier"), "topic", "hostname", "received", "sent")
    vip = counts.where("tier = 'COLLECTOR'").groupBy("cluster", "topic").agg(F.sum("received").alias("received"), F.sum("sent").alias("sent"))
    return counts.unionByName(vip.select(F.lit("VIP").alias("name"), "cluster", F.lit("VIP").alias("tier"), "topic", F.lit(None).cast("string").alias("hostname"), "received", "sent"))


def tier_links(nodes: DataFrame, sources: DataFrame) -> DataFrame:
    """parent and child nodes (name, cluster, tier of each) of every edge. nodes: name, cluster, tier."""
    chain = nodes.sparkSession.createDataFrame(CHAIN, "parent_tier string, child_tier string, by string")
    named = lambda p: nodes.select(*(F.col(c).alias(f"{p}_{c}") for c in ("name", "cluster", "tier"))).distinct()
    up = named("parent").join(F.broadcast(chain), "parent_tier")  # seven rows
    same = lambda a, b: F.col(a) == F.col(b)
    child = named("child").withColumnRenamed("child_tier", "own_tier")
    near = [same("child_tier", "own_tier"), same("parent_cluster", "child_cluster")]
    within = up.where("by = 'cluster'").join(child, near).unionByName(up.where("by = 'host'").join(child, [*near, same("parent_name", "child_name")]))
    feed = sources.select(F.col("tier").alias("parent_tier"), F.col("cluster").alias("parent_cluster"), F.col("source").alias("child_cluster"))
    across = up.where("by = 'source'").join(feed, ["parent_tier", "parent_cluster"]).join(named("child"), ["child_tier", "child_cluster"])
    cols = [f"{p}_{c}" for p in ("parent", "child") for c in ("name", "cluster", "tier")]
    return within.select(*cols).unionByName(across.select(*cols))


def topic_sources(source: DataFrame, dest: DataFrame) -> DataFrame:
    """tier, cluster, topic, source: source_clusters by the streams that the node has."""
    lists = source_clusters(source, dest)
    own = dest.select(F.when(F.col("is_primary"), "MERGE").otherwise("MIRROR").alias("tier"), "cluster", F.col("stream").alias("topic")).distinct()
    return own.join(lists, ["tier", "cluster"])


def link_health(tuples: DataFrame, source: DataFrame, dest: DataFrame, loss_percent: int) -> DataFrame:
    """Every edge with what its parent has and what its children have, and status: nofill, loss or healthy.

    A collector stands for all collectors of its cluster; an HDFS node is held against what each collector sent, by topic
    and host; a merge or mirror node only counts the topics that the child feeds; all others count what was received."""
    rows = _nodes(tuples)
    nodes = rows.groupBy("name", "cluster", "tier").agg(F.sum("received").alias("received"), F.sum("sent").alias("sent"))
    links = tier_links(nodes, source_clusters(source, dest))
    of = lambda p, cols: nodes.select(*(F.col(c).alias(f"{p}_{c}") for c in ("name", "cluster", "tier", *cols)))
    keys = lambda p: [f"{p}_{c}" for c in ("name", "cluster", "tier")]
    links = links.join(of("parent", ["received"]), keys("parent")).join(of("child", ["received", "sent"]), keys("child"))
    collectors = nodes.where("tier = 'COLLECTOR'").groupBy(F.col("cluster").alias("parent_cluster")).agg(F.sum("received").alias("all_collectors"))
    links = links.join(collectors, "parent_cluster", "left")
    hdfs = rows.where("tier = 'HDFS'").select(F.col("name").alias("parent_name"), F.col("cluster").alias("parent_cluster"), "topic", F.col("hostname").alias("child_name"), F.col("received").alias("up"))
    sent = rows.where("tier = 'COLLECTOR'").select(F.col("name").alias("child_name"), F.col("cluster").alias("parent_cluster"), "topic", F.col("sent").alias("down"))
    pairs = hdfs.join(sent, ["child_name", "parent_cluster", "topic"]).groupBy("parent_name", "parent_cluster", "child_name").agg(F.sum("up").alias("hdfs_up"), F.sum("down").alias("hdfs_down")).withColumn("parent_tier", F.lit("HDFS"))
    links = links.join(pairs, ["parent_name", "parent_cluster", "child_name", "parent_tier"], "left")
    below = rows.groupBy("tier", "cluster", "topic").agg(F.sum("received").alias("n"))
    fed = topic_sources(source, dest).withColumn("below", F.when(F.col("tier") == "MERGE", "LOCAL").otherwise("MERGE"))
    fed = fed.join(below.select(F.col("tier").alias("below"), F.col("cluster").alias("source"), "topic", "n"), ["below", "source", "topic"])
    fed = fed.groupBy(F.col("tier").alias("parent_tier"), F.col("cluster").alias("parent_cluster")).agg(F.sum("n").alias("fed"))
    links = links.join(fed, ["parent_tier", "parent_cluster"], "left")
    plain = links.groupBy(*keys("parent")).agg(F.sum("child_received").alias("plain"))
    links = links.join(plain, keys("parent"))
    across = F.col("parent_tier").isin("MERGE", "MIRROR")
    up = F.when(F.col("parent_tier") == "COLLECTOR", F.col("all_collectors")).when(F.col("parent_tier") == "HDFS", F.coalesce("hdfs_up", F.lit(0))).otherwise(F.col("parent_received"))
    down = F.when(across, F.coalesce("fed", F.lit(0))).when(F.col("parent_tier") == "HDFS", F.coalesce("hdfs_down", F.lit(0))).otherwise(F.col("plain"))
    links = links.withColumns({"above": up.cast("long"), "beneath": down.cast("long")})
    empty = (F.col("parent_received") == 0) | (F.col("child_received") == 0) | (F.col("child_tier").isin("AGENT", "COLLECTOR") & (F.col("child_sent") == 0))
    status = F.when(empty, "nofill").when(is_loss(F.col("above"), F.col("beneath"), loss_percent), "loss").otherwise("healthy")
    return links.select(*keys("parent"), *keys("child"), "above", "beneath", status.alias("status"))


def streams_losing_data(tuples: DataFrame, source: DataFrame, dest: DataFrame, loss_percent: int) -> DataFrame:
    """Topics of an edge that are below it and above it missing or short."""
    rows = _nodes(tuples)
    nodes = rows.select("name", "cluster", "tier").distinct()
    links = tier_links(nodes, source_clusters(source, dest))
    totals = rows.groupBy("name", "cluster", "tier", "topic").agg(F.sum("received").alias("received"), F.sum("sent").alias("sent"))
    child = totals.select(F.col("name").alias("child_name"), F.col("cluster").alias("child_cluster"), F.col("tier").alias("child_tier"), "topic", "received", "sent")
    below = links.join(child, ["child_name", "child_cluster", "child_tier"]).withColumn("beneath", F.when(F.col("parent_tier") == "HDFS", F.col("sent")).otherwise(F.col("received")))
    by_host = rows.where("tier = 'HDFS'").select("name", "cluster", "tier", "topic", F.col("hostname").alias("host"), F.col("received").alias("above"))
    collectors = totals.where("tier = 'COLLECTOR'").groupBy("cluster", "tier", "topic").agg(F.sum("received").alias("above"))
    collectors = nodes.where("tier = 'COLLECTOR'").join(collectors, ["cluster", "tier"]).select("name", "cluster", "tier", "topic", F.lit(None).cast("string").alias("host"), "above")
    other = totals.where("tier not in ('HDFS', 'COLLECTOR')").select("name", "cluster", "tier", "topic", F.lit(None).cast("string").alias("host"), F.col("received").alias("above"))
    above = by_host.unionByName(collectors).unionByName(other).select(F.col("name").alias("parent_name"), F.col("cluster").alias("parent_cluster"), F.col("tier").alias("parent_tier"), "topic", "host", "above")
    both = below.withColumn("host", F.when(F.col("parent_tier") == "HDFS", F.col("child_name"))).alias("b").join(
        above.alias("a"), [F.col(f"b.{c}") == F.col(f"a.{c}") for c in ("parent_name", "parent_cluster", "parent_tier", "topic")] + [F.col("b.host").eqNullSafe(F.col("a.host"))], "left"
    )
    feeds = topic_sources(source, dest).select(F.col("tier").alias("f_tier"), F.col("cluster").alias("f_cluster"), F.col("topic").alias("f_topic"), F.col("source").alias("f_source"))
    both = both.join(feeds, (F.col("b.parent_tier") == F.col("f_tier")) & (F.col("b.parent_cluster") == F.col("f_cluster")) & (F.col("b.topic") == F.col("f_topic")) & (F.col("b.child_cluster") == F.col("f_source")), "left")
    across = F.col("b.parent_tier").isin("MERGE", "MIRROR")
    short = F.when(across, F.col("f_source").isNotNull() & F.col("above").isNotNull() & is_loss(F.col("above"), F.col("beneath"), loss_percent)).otherwise(F.col("above").isNull() | is_loss(F.col("above"), F.col("beneath"), loss_percent))
    return both.where(short).select(*(F.col(f"b.{c}").alias(c) for c in ("parent_name", "parent_cluster", "parent_tier", "child_name", "child_cluster", "child_tier", "topic"))).distinct()


def comparable_upstream(tuples: DataFrame, source: DataFrame, dest: DataFrame) -> DataFrame:
    """tier (MERGE, MIRROR) and upstream: what (source cluster, topic) pairs that feed its nodes received; -1 without nodes."""
    rows = settled(topic_counts(tuples).groupBy(F.upper("tier").alias("tier"), "cluster", "topic").agg(F.sum("received").alias("n")))
    fed = topic_sources(source, dest).join(rows.select("tier", "cluster", "topic"), ["tier", "cluster", "topic"])
    fed = fed.withColumn("below", F.when(F.col("tier") == "MERGE", "LOCAL").otherwise("MERGE"))
    sums = fed.join(rows.select(F.col("tier").alias("below"), F.col("cluster").alias("source"), "topic", "n"), ["below", "source", "topic"], "left").groupBy("tier").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("upstream"))
    both = tuples.sparkSession.createDataFrame([("MERGE",), ("MIRROR",)], "tier string")
    return both.join(sums, "tier", "left").select("tier", F.coalesce("upstream", F.lit(-1)).cast("long").alias("upstream"))


def tier_count_summary(tuples: DataFrame, source: DataFrame, dest: DataFrame, loss_percent: int, warn_percent: int) -> DataFrame:
    """received, sent, upstream and health of each tier. The publisher has none above it to be held against."""
    per = settled(tuples.groupBy(F.upper("tier").alias("tier")).agg(F.sum(received()).alias("received"), F.sum("sent").alias("sent")))
    before = tuples.sparkSession.createDataFrame([("AGENT", "PUBLISHER", False), ("COLLECTOR", "AGENT", True), ("HDFS", "COLLECTOR", True), ("LOCAL", "HDFS", False)], "tier string, before string, by_sent boolean")
    up = before.join(per.select(F.col("tier").alias("before"), F.col("received").alias("r"), F.col("sent").alias("s")), "before").select("tier", F.when(F.col("by_sent"), F.col("s")).otherwise(F.col("r")).alias("upstream"))
    up = up.unionByName(comparable_upstream(tuples, source, dest))
    both = per.join(up, "tier", "left")
    verdict = F.when(F.col("tier") == "PUBLISHER", F.when(F.col("received") == 0, "NoData").otherwise("Healthy")).otherwise(health(F.col("received"), F.coalesce("upstream", F.lit(0)), loss_percent, warn_percent))
    return both.select("tier", "received", "sent", F.coalesce("upstream", F.lit(0)).alias("upstream"), verdict.alias("health"))


def cluster_scope(source: DataFrame, dest: DataFrame, cluster: str) -> DataFrame:
    """The clusters (cluster) that a cluster's data comes from, itself included: a mirror's merge clusters, and all clusters that feed merges."""
    feeds = source_clusters(source, dest)
    own = source.sparkSession.createDataFrame([(cluster,)], "cluster string")
    step = lambda rows, tier: rows.join(feeds.where(F.col("tier") == tier), "cluster").select(F.col("source").alias("cluster"))
    merges = own.unionByName(step(own, "MIRROR"))
    return merges.unionByName(step(merges, "MERGE")).distinct()


def filter_topology(tuples: DataFrame, streams: list[str] | None = None, cluster: str | None = None, source: DataFrame | None = None, dest: DataFrame | None = None) -> DataFrame:
    """Nodes as the given streams alone make them (None: all), and of a cluster's scope alone if one is given.

    sources: the clusters that a merge or mirror node gets any of the streams that it still has from; null of other nodes, or without tables."""
    rows = tuples if streams is None else tuples.where(F.col("topic").isin(streams))
    if cluster is not None:
        rows = rows.join(cluster_scope(source, dest, cluster), "cluster", "left_semi")
    nodes = topology_nodes(rows, [99.0])
    if source is None or dest is None:
        return nodes.drop("stats")
    topics = nodes.where("upper(tier) in ('MERGE', 'MIRROR')").select("name", "cluster", "tier", F.explode("stats.topic").alias("topic"))
    fed = topic_sources(source.where("enabled"), dest).withColumnRenamed("tier", "kind")
    lists = topics.join(fed, (F.upper("tier") == F.col("kind")) & (topics["cluster"] == fed["cluster"]) & (topics["topic"] == fed["topic"]))
    lists = lists.groupBy("name", topics["cluster"], "tier").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    return nodes.drop("stats").join(lists, ["name", "cluster", "tier"], "left")


def sent_vs_received(tuples: DataFrame) -> DataFrame:
    """Topics of nodes that forward, with whether they sent what they received."""
    rows = topic_counts(tuples).where("upper(tier) in ('AGENT', 'COLLECTOR')").groupBy("name", "cluster", "tier", "topic").agg(F.sum("received").alias("received"), F.sum("sent").alias("sent"))
    return rows.withColumn("mismatch", F.col("sent") != F.col("received"))
