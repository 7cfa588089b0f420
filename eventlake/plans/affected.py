"""Which keys of dimensions and marts a set of changed rows touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.scope import key_union, restrict


def day() -> Column:
    return F.to_date("event_time").alias("activity_date")


def hour() -> Column:
    return F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("window_start")


def post_keys(posts: DataFrame, deletes: DataFrame) -> DataFrame:
    """Posts created, updated or deleted in the given Silver rows."""
    from eventlake.operators.modeled import POST, deleted

    return key_union([posts.select("post_uri"), deleted(deletes, POST).select(F.col("record_uri").alias("post_uri"))])


def actor_keys(posts: DataFrame, engagements: DataFrame, follows: DataFrame, deletes: DataFrame) -> DataFrame:
    """Actors in any role in the given Silver rows."""
    roles = [posts.select(F.col("author_did").alias("actor_did")), engagements.select("actor_did"), follows.select("actor_did"), follows.select(F.col("target_actor_did").alias("actor_did")), deletes.select(F.col("repository_did").alias("actor_did"))]
    return key_union(roles)


def performance_posts(content: DataFrame, engagements: DataFrame) -> DataFrame:
    """Posts with changed content events or engagements."""
    return key_union([content.select("post_uri"), engagements.select(F.col("target_post_uri").alias("post_uri"))])


def hours(content: DataFrame, all_content: DataFrame) -> DataFrame:
    """Hours of changed events, and the hours in which any touched post was created: its text length counts there."""
    made = restrict(all_content.where(F.col("content_event_type").isin("post_create", "reply_create")), content.select("post_uri").distinct(), ["post_uri"])
    return key_union([content.select(hour()), made.select(hour())], drop_nulls=False)


def threads(content: DataFrame, all_content: DataFrame) -> DataFrame:
    """Roots of changed events, touched posts as roots, and roots of all events of touched posts."""
    touched = content.select("post_uri").distinct()
    of_touched = restrict(all_content, touched, ["post_uri"])
    return key_union([content.select("reply_root_uri"), touched.select(F.col("post_uri").alias("reply_root_uri")), of_touched.select("reply_root_uri")])


def actor_days(content: DataFrame, engagements: DataFrame, network: DataFrame, all_engagements: DataFrame, dim_posts: DataFrame) -> DataFrame:
    """(day, actor) of changed events as doer and as receiver, and of earlier engagements on posts whose state changed."""
    authors = dim_posts.select(F.col("post_uri").alias("target_post_uri"), F.col("author_did").alias("actor_did")).where(F.col("actor_did").isNotNull())
    touched = content.select(F.col("post_uri").alias("target_post_uri")).distinct()
    received = engagements.unionByName(restrict(all_engagements, touched, ["target_post_uri"])).select("target_post_uri", day()).join(authors, "target_post_uri").select("activity_date", "actor_did")
    keys = key_union([content.select(day(), F.col("author_did").alias("actor_did")), engagements.select(day(), "actor_did"), network.select(day(), "actor_did"), received], drop_nulls=False)
    return keys.where(F.col("actor_did").isNotNull())


def network_days(network: DataFrame) -> DataFrame:
    """(day, target) of changed network events; a null target is a key too."""
    return key_union([network.select(day(), "target_actor_did")], drop_nulls=False)
