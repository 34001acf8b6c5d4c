"""Table permissions: who may read what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import list_items, strip


def user_grants(users: DataFrame) -> DataFrame:
    """One row per user and granted table."""
    return users.select("username", F.explode(list_items("allowed_tables")).alias("table_name"))


def _granted(deny_if_empty: bool) -> Column:
    listed = F.array_contains(F.col("_granted"), strip("table_name"))
    everything = F.lit(False) if deny_if_empty else F.size("_granted") == 0
    return listed | everything


def checked_requests(requests: DataFrame, users: DataFrame, deny_if_empty: bool = False) -> DataFrame:
    """All requests ``(username, table_name)`` with an ``authorized`` flag; an unknown user may read nothing.

    An empty list of grants stands for every table unless ``deny_if_empty``.  Grants
    travel as one array per user, so a user with many requests costs one join.
    """
    granted = users.select("username", list_items("allowed_tables").alias("_granted"))
    joined = requests.join(granted, "username", "left")
    return joined.withColumn("authorized", F.coalesce(_granted(deny_if_empty), F.lit(False))).drop("_granted")


def request_audit(requests: DataFrame, users: DataFrame, deny_if_empty: bool = False) -> DataFrame:
    """Every request with ``authorized`` and, where it is refused, the reason."""
    known = users.select("username", F.lit(True).alias("_known")).distinct()
    checked = checked_requests(requests, users, deny_if_empty).join(known, "username", "left")
    reason = F.when(F.col("_known").isNull(), "unknown user").when(~F.col("authorized"), "not granted")
    return checked.withColumn("reason", reason).drop("_known")


def authorized_tables(requests: DataFrame, users: DataFrame, deny_if_empty: bool = False) -> DataFrame:
    return checked_requests(requests, users, deny_if_empty).where("authorized").drop("authorized")


def unauthorized_tables(requests: DataFrame, users: DataFrame, deny_if_empty: bool = False) -> DataFrame:
    return checked_requests(requests, users, deny_if_empty).where("NOT authorized").drop("authorized")


def allowed_users(requests: DataFrame, users: DataFrame, deny_if_empty: bool = False) -> DataFrame:
    """Per user: may every requested table be read?"""
    checked = checked_requests(requests, users, deny_if_empty)
    return checked.groupBy("username").agg(F.bool_and("authorized").alias("allowed"))
