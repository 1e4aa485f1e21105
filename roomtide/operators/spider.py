"""Discovery of creators from battles: opponents, first discoveries and repeated spidering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.functions.identity import filled
from roomtide.operators.joins import join_unique
from roomtide.operators.registry import as_registry_events
from roomtide.runtime import cut_lineage

BATTLE_ARCHETYPE = "pk_battler"


def _handle_of(user: Column) -> Column:
    return F.coalesce(filled(user["display_id"]), filled(user["unique_id"]))


def _anchor_user(anchor: Column) -> Column:
    """An anchor names its creator under ``user``, else ``anchor``, else itself."""
    itself = F.struct(anchor["display_id"].alias("display_id"), anchor["unique_id"].alias("unique_id"))
    return F.coalesce(anchor["user"], anchor["anchor"], itself)


def battle_opponents(battles: DataFrame) -> DataFrame:
    """(seq, ts, host, opponent): the distinct peers of each battle, lower case, without the host."""
    anchors = F.transform(
        F.coalesce("anchors", F.array()), lambda a: F.lower(_handle_of(_anchor_user(a)))
    )
    everyone = F.array_union(anchors, F.array(F.lower(_handle_of(F.col("rival")))))
    host = F.lower("host")
    exploded = battles.select("seq", "ts", host.alias("host"), F.explode(everyone).alias("opponent"))
    return exploded.where(F.col("opponent").isNotNull() & (F.col("opponent") != F.col("host")))


def meetings(battles: DataFrame) -> DataFrame:
    """Distinct (host, opponent) pairs with their first battle.

    Repeated battles collapse on the map side, before anything else is joined.
    """
    return battle_opponents(battles).groupBy("host", "opponent").agg(F.min("seq").alias("seq"))


def _inherited(category: Column, archetype: Column) -> Column:
    return F.when(category == "npc", F.lit(BATTLE_ARCHETYPE)).otherwise(archetype)


def _finds(pairs: DataFrame, hosts: DataFrame) -> DataFrame:
    """(username, first, named): of every creator met by ``hosts``, known or not, the first meeting and the
    first one that tells more than ``general``; both as (seq, host, category, archetype).

    ``hosts`` has one row per username. The category and archetype that a meeting gives are the host's. All meetings
    are aggregated by number alone, which hashes; the texts of the few that decide are looked up afterwards.
    """
    finder = hosts.select(F.col("username").alias("host"), "category", "archetype")
    met = join_unique(pairs, finder, "host", ["opponent"]).withColumn(
        "given", _inherited(F.col("category"), F.coalesce("archetype", F.lit("general")))
    )
    named = F.col("given") != "general"
    numbers = met.groupBy("opponent").agg(F.min("seq").alias("first_seq"), F.min(F.when(named, F.col("seq"))).alias("named_seq"))
    deciding = numbers.withColumn("seq", F.explode(F.array_distinct(F.array_compact(F.array("first_seq", "named_seq")))))
    meeting = F.struct("seq", "host", "category", F.col("given").alias("archetype"))
    texts = met.join(deciding, ["opponent", "seq"]).groupBy("opponent", "first_seq", "named_seq").agg(F.collect_list(meeting).alias("told"))
    first = F.filter("told", lambda m: m["seq"] == F.col("first_seq"))
    better = F.filter("told", lambda m: (m["seq"] == F.col("named_seq")) & (m["archetype"] != "general"))
    return texts.select(F.col("opponent").alias("username"), F.array_min(first).alias("first"), F.array_min(better).alias("named"))


def _source(host: Column) -> Column:
    return F.concat(F.lit("pk_battle_@"), host)


def _new(finds: DataFrame, known: DataFrame) -> DataFrame:
    """Finds that are not in ``known``, with the archetype they end up with: a later, better one counts."""
    found = finds.join(known.select("username"), "username", "left_anti")
    return found.select(
        "username",
        F.col("first.category").alias("category"),
        F.coalesce("named.archetype", "first.archetype").alias("archetype"),
        _source(F.col("first.host")).alias("source"),
        F.col("first.seq").alias("seq"),
    )


def discover(battles: DataFrame, registry: DataFrame) -> DataFrame:
    """Creators not yet in ``registry`` that its members met in battle."""
    return _new(_finds(meetings(battles), registry), registry)


def discovery_events(found: DataFrame) -> DataFrame:
    """Discoveries as ``add`` events of the registry log."""
    added = found.withColumnRenamed("username", "handle").withColumn("op", F.lit("add"))
    return as_registry_events(added)


def meeting_events(battles: DataFrame, registry: DataFrame) -> DataFrame:
    """What battles tell the registry, as ``add`` events: of every creator met, known ones included, the first
    meeting, and the first that names an archetype. The fold keeps the first add and lets the other one
    replace ``general``; more adds of the same creator would change nothing."""
    finds = _finds(meetings(battles), registry)
    both = F.array_compact(F.array("first", F.when(F.col("named.seq") > F.col("first.seq"), F.col("named"))))
    rows = finds.select("username", F.explode(both).alias("m"))
    return discovery_events(
        rows.select(
            "username", F.col("m.category").alias("category"), F.col("m.archetype").alias("archetype"),
            _source(F.col("m.host")).alias("source"), F.col("m.seq").alias("seq"),
        )
    )


def discover_reach(battles: DataFrame, registry: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Repeated spidering: discovered creators are captured and spidered in their turn, until no new one is found.

    Gives (username, hop, category, archetype, source); the registry's own creators have hop 0. A creator's
    archetype is settled within the hop that finds it, before the creator is spidered. ``max_hops`` ends
    sooner. Each hop's finds are written to the checkpoint folder, so that lineage stays short and a
    lost executor costs no earlier hop.
    """
    pairs = cut_lineage(meetings(battles))
    columns = ["username", "category", "archetype", "source"]
    start = registry if "source" in registry.columns else registry.withColumn("source", F.lit("seed"))
    reached = frontier = cut_lineage(start.select(*columns, F.lit(0).alias("hop")))
    hop = 0
    while max_hops is None or hop < max_hops:
        hop += 1
        found = _new(_finds(pairs, frontier), reached).select(*columns, F.lit(hop).alias("hop"))
        frontier = cut_lineage(found)
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached
