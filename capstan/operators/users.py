"""User and manager lookups (user table joined to itself through ManagerUserID)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.config import Config


def buyer_users(users: DataFrame, cfg: Config) -> DataFrame:
    """Users with an ERP user code, minus excluded accounts.

    ``SAPUserID != ''`` and ``UserID NOT IN (...)`` both drop NULLs, as in SQL.
    """
    return users.where((F.col("SAPUserID") != "") & ~F.col("UserID").isin(*cfg.excluded_user_ids))


def with_user(df: DataFrame, users: DataFrame, on: str, user_key: str, name_as: str, manager_as: str,
              managers: DataFrame | None = None) -> DataFrame:
    """Left-join the user whose ``user_key`` equals ``df[on]`` and that user's manager.

    Adds ``name_as`` (DisplayName) and ``manager_as`` (the manager's
    DisplayName, looked up by UserID in ``managers``, default ``users``).
    Several users may share a ``user_key`` (fan-out kept).
    """
    tag = name_as
    u = users.select(F.col(user_key).alias(f"__{tag}_key"), F.col("DisplayName").alias(name_as),
                     F.col("ManagerUserID").alias(f"__{tag}_mgr"))
    m = (users if managers is None else managers).select(F.col("UserID").alias(f"__{tag}_mid"),
                                                         F.col("DisplayName").alias(manager_as))
    # users joined to their managers first (dimension side only), so the large
    # side is probed once per lookup instead of twice
    people = u.join(m, F.col(f"__{tag}_mgr") == F.col(f"__{tag}_mid"), "left").drop(f"__{tag}_mgr", f"__{tag}_mid")
    return df.join(people, F.col(on) == F.col(f"__{tag}_key"), "left").drop(f"__{tag}_key")
