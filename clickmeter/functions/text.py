"""Text cleaning and hashing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmeter.settings import BEARER_PREFIX, BLANK_CHARS, DEFAULT_SALT


def presence(text: Column) -> Column:
    """Trimmed text, or null when nothing but blanks is left."""
    return F.nullif(F.btrim(text, F.lit(BLANK_CHARS)), F.lit(""))


def bearer_principal(authorization: Column) -> Column:
    """The advertiser a `Bearer` header speaks for; null for any other header."""
    token = F.substring(authorization, len(BEARER_PREFIX) + 1, 2**31 - 1)
    return F.when(authorization.startswith(BEARER_PREFIX), presence(token))


def salt_of(key: Column, factor: int = DEFAULT_SALT) -> Column:
    """Stable salt in `[0, max(factor, 1))`: a retried task gets the same one."""
    return F.pmod(F.xxhash64(key), F.lit(max(int(factor), 1))).cast("int")


def salted_key(key: Column, spread_by: Column, factor: int = DEFAULT_SALT) -> Column:
    """`key:salt`, so that one hot key fans out over `factor` partitions."""
    return F.concat_ws(":", key, salt_of(spread_by, factor).cast("string"))
