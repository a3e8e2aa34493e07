"""What an asker had earned before asking (C2, C4, C5, D4; M5, M6).

For each ask ``(id, user, t)`` the result lists the names of the user's
earlier events (``ts < t``, strict), oldest first, joined by a space.

Plan: asks and events form one timeline per user. A user with more than
``rows_per_split`` rows has its timeline cut into value ranges of the time
key (``ordered.hot_group_buckets``), so a user holding a third of all events
is spread over many window partitions; other users stay whole (one range)
and need no lookup at all:

1. inside a range, rows are ordered ``(ts, kind, id)`` (asks before events at
   the same instant, so equal timestamps are excluded) and numbered by the
   asks before them; the events between two asks become one chunk, and a
   running concat over chunks, one row per ask, gives each ask the earlier
   events of its range. No list is built at an event row;
2. per range, the range's own event names (bounded by the range size);
3. a range with asks gets the names of its user's earlier ranges: each range's
   names go to the later ranges that have asks, and are joined there, one task
   per range, not per user;
4. an ask's list is (3) of its range followed by (1).

No (ask, event) pair is ever materialised; the only growth is the output
itself, the list of all earlier names of each ask, which is one value.
An ask without a user or a time has no earlier events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import DEFAULT_ROWS_PER_SPLIT, hot_group_buckets, numeric_key


def prior_events(
    asks: DataFrame,
    events: DataFrame,
    how: str = "left",
    ask_id: str = "id",
    ask_user: str = "owneruserid",
    ask_ts: str = "creationdate",
    ev_id: str = "id",
    ev_user: str = "userid",
    ev_ts: str = "date",
    ev_name: str = "name",
    sep: str = " ",
    rows_per_split: int = DEFAULT_ROWS_PER_SPLIT,
) -> DataFrame:
    """Prior event names per ask.

    ``how="left"`` keeps every ask (``''`` when none, as ``ExtractBadge``);
    ``how="inner"`` keeps asks with at least one earlier event (``main``).
    Output: ``id, userid, badges, n_badges``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    a = asks.select(
        F.col(ask_id).cast("bigint").alias("_id"),
        F.col(ask_user).cast("bigint").alias("_user"),
        F.col(ask_ts).cast("timestamp_ntz").alias("_ts"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast("string").alias("_name"),
    )
    e = events.select(
        F.col(ev_id).cast("bigint").alias("_id"),
        F.col(ev_user).cast("bigint").alias("_user"),
        F.col(ev_ts).cast("timestamp_ntz").alias("_ts"),
        F.lit(1).alias("_kind"),
        F.col(ev_name).cast("string").alias("_name"),
    ).where(F.col("_user").isNotNull() & F.col("_ts").isNotNull())

    dated = F.col("_user").isNotNull() & F.col("_ts").isNotNull()
    timeline = a.where(dated).unionByName(e)
    b, any_split = hot_group_buckets(
        timeline, ["_user"], numeric_key(F.col("_ts"), "timestamp"), rows_per_split
    )

    order = [F.col("_ts"), F.col("_kind"), F.col("_id")]
    earlier = (
        Window.partitionBy("_user", "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    event = F.when(F.col("_kind") == 1, F.struct(*order, "_name"))
    asks_before = F.coalesce(F.sum(1 - F.col("_kind")).over(earlier), F.lit(0))
    chunks = (
        b.withColumn("_seg", asks_before)
        .groupBy("_user", "_bucket", "_seg")
        .agg(
            F.max(F.when(F.col("_kind") == 0, F.col("_id"))).alias("_id"),
            F.max(F.col("_kind") == 0).alias("_ask"),
            F.transform(F.sort_array(F.collect_list(event)), lambda x: x["_name"]).alias("_names"),
        )
    )
    chunks = chunks.withColumn(
        "_names", F.filter("_names", lambda x: x.isNotNull())
    )
    so_far = (
        Window.partitionBy("_user", "_bucket")
        .orderBy("_seg")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    partial = (
        chunks.withColumn("_partial", F.flatten(F.collect_list("_names").over(so_far)))
        .where("_ask")
        .select("_id", "_user", "_bucket", "_partial")
    )

    empty = F.array().cast("array<string>")
    if not any_split:
        lists = partial.select("_id", "_user", F.col("_partial").alias("_all"))
    else:
        # only the ranges of split users: one row per range, rows / rows_per_split
        # of them, which bounds what is broadcast
        split = b.where("_split")
        asking = split.where(F.col("_kind") == 0).select("_user", F.col("_bucket").alias("_to")).distinct()
        names = (
            split.where((F.col("_kind") == 1) & F.col("_name").isNotNull())
            .groupBy("_user", "_bucket")
            .agg(F.sort_array(F.collect_list(F.struct(*order, "_name"))).alias("_evs"))
            .select("_user", "_bucket", F.transform("_evs", lambda x: x["_name"]).alias("_evs"))
        )
        targets = asking.groupBy("_user").agg(F.collect_list("_to").alias("_tos"))
        sent = names.join(F.broadcast(targets), "_user").select(
            "_user", "_bucket", "_evs", F.explode(F.filter("_tos", lambda t: t > F.col("_bucket"))).alias("_to")
        )
        prefix = (
            sent.groupBy("_user", F.col("_to").alias("_bucket"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_bucket").alias("_from"), "_evs"))).alias("_parts"))
            .select("_user", "_bucket", F.flatten(F.transform("_parts", lambda x: x["_evs"])).alias("_prefix"))
        )
        lists = partial.join(prefix, ["_user", "_bucket"], "left").select(
            "_id", "_user", F.concat(F.coalesce("_prefix", empty), "_partial").alias("_all")
        )

    out = lists.select(
        F.col("_id").alias("id"),
        F.col("_user").alias("userid"),
        F.array_join("_all", sep).alias("badges"),
        F.size("_all").cast("bigint").alias("n_badges"),
    )
    if how == "inner":
        return out.where(F.col("n_badges") > 0)
    undated = a.where(~dated).select(
        F.col("_id").alias("id"),
        F.col("_user").alias("userid"),
        F.lit("").alias("badges"),
        F.lit(0).cast("bigint").alias("n_badges"),
    )
    return out.unionByName(undated)


def attach_owner(posts: DataFrame, owners: DataFrame, key: str = "id", owner: str = "owneruserid"):
    """Inner join of posts to their asker (C2): the reference's
    ``merge(qa, questioner, on='id')``; posts without an owner row drop."""
    return posts.join(owners.select(key, owner), key, "inner")
