"""Joins of the facts with a table of one row per key (header, rates, file).

The keyed table is stored and measured. Up to ``BROADCAST_BYTES`` it goes to every
task and the facts stay where they are. Beyond that both sides are dealt out by the
key and a salt, so a key that holds a third of all facts spreads over ``SALTS`` tasks;
the keyed table is repeated once a salt. In neither case do facts move by the key alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

BROADCAST_BYTES = 32 << 20
SALTS = 64


def size_of(df: DataFrame) -> int:
    """Bytes of a table's values as text, a bound on what its rows carry."""
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})))).first()[0] or 0


def join_keyed(facts: DataFrame, keyed: DataFrame, key: str, how: str = "inner",
               broadcast_bytes: int | None = None, salts: int = SALTS) -> DataFrame:
    """Join ``facts`` with ``keyed`` (one row per ``key``, other names than the facts')."""
    keyed = stored(keyed, "keyed")
    if size_of(keyed) <= (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return facts.join(F.broadcast(keyed), key, how)
    hashed = [F.col(f"`{f.name}`") for f in facts.schema if not holds_map(f.dataType)]
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
    spread = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread.hint("shuffle_hash"), [key, "_salt"], how).drop("_salt")


def holds_map(kind: T.DataType) -> bool:
    """Maps have no hash; a salt leaves them out."""
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(holds_map(f.dataType) for f in kind)
