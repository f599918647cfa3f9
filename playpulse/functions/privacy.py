"""Pseudonymisation and small-group suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.config import DEFAULT_MINIMUM_PRIVACY_GROUP

# Fixed value: the stand-in hashed for a missing player id.
MISSING_PLAYER = "missing"


def check_salt(salt: str | None) -> str:
    if salt is None or salt == "":
        raise ValueError("a non-empty player hash salt is required")
    return salt


def player_key(user_id: str | Column, salt: str) -> Column:
    """``sha2(salt || coalesce(user_id, 'missing'), 256)`` as 64 hex characters."""
    uid = F.col(user_id) if isinstance(user_id, str) else user_id
    return F.sha2(F.concat(F.lit(check_salt(salt)), F.coalesce(uid, F.lit(MISSING_PLAYER))), 256)


def pseudonymize_player_id(
    events: DataFrame, salt: str, id_column: str = "user_id", key_column: str = "player_key"
) -> DataFrame:
    """Replace the raw player id with its salted SHA-256 hash (the raw column is dropped)."""
    return events.withColumn(key_column, player_key(id_column, salt)).drop(id_column)


def suppress_small_groups(
    aggregates: DataFrame,
    group_size: str | Column,
    minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP,
) -> DataFrame:
    """Keep rows whose supporting group has at least ``minimum_group_size`` members."""
    size = F.col(group_size) if isinstance(group_size, str) else group_size
    return aggregates.filter(size >= F.lit(minimum_group_size))
