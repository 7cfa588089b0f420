"""Pseudonyms: HMAC over SHA-256 by SQL functions, under numbered keys."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
#: Keys of the registered query; real ones come from a secret store.
DEMO_KEYS = {1: b"first key", 2: b"second key, longer than a block of the hash function, so that it is hashed before use"}


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Lowercase hex of HMAC-SHA256 of a string's UTF-8 bytes; null stays null.  The key, a secret, is in the plan: mind who reads it."""
    key = (hashlib.sha256(key).digest() if len(key) > BLOCK else key).ljust(BLOCK, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in key)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))), 256)


def pseudonym(column: str | Column, keys: Mapping[int, bytes], version: int | None = None) -> Column:
    """``v<version>:<hmac>`` under the key of ``version``, by default the newest: equal values have equal pseudonyms, and the version tells its key."""
    version = max(keys) if version is None else version
    value = F.col(column) if isinstance(column, str) else column
    return F.concat(F.lit(f"v{version}:"), hmac_sha256(keys[version], value))


def renamed(df: DataFrame, columns: list[str], keys: Mapping[int, bytes], version: int | None = None) -> DataFrame:
    """``df`` with pseudonyms in place of ``columns``; joins and groups by them give what they gave before."""
    return df.withColumns({c: pseudonym(c, keys, version) for c in columns})


def rotation(ids: DataFrame, column: str, keys: Mapping[int, bytes], old: int, new: int) -> DataFrame:
    """old_pseudonym, new_pseudonym of each distinct id: the bridge by which tables under an old key join those under a new one."""
    return ids.select(column).where(F.col(column).isNotNull()).distinct().select(pseudonym(column, keys, old).alias("old_pseudonym"), pseudonym(column, keys, new).alias("new_pseudonym"))


def rekeyed(df: DataFrame, column: str, bridge: DataFrame) -> DataFrame:
    """``df`` with its old pseudonyms in ``column`` replaced by new ones; what the bridge doesn't have stays."""
    joined = df.join(bridge, df[column] == bridge["old_pseudonym"], "left")
    return joined.withColumn(column, F.coalesce("new_pseudonym", column)).select(df.columns)
