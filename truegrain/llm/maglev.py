"""Placement of documents on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size:
``offset + k * skip``. The shards take turns, each claiming the first free slot of its
order, until the table is full; so all shards have nearly the same number of slots, and
few slots change hands if a shard comes or goes. The table has ``slots`` entries whatever
the size of the data, so broadcasting it is bounded; a document then needs one lookup.

Cases: a NULL key is placed as the empty one; equal keys share a shard; an empty table
gives no rows; columns named ``slot`` or ``shard`` in the input are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A prime; the table is broadcast, so it may not have more entries than ``MOST_SLOTS``.
SLOTS = 65_537
MOST_SLOTS = 1_000_003


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The position in ``shards`` of the owner of every slot."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards: different names, at least one, not more than slots")
    if not _is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"slots: a prime of at most {MOST_SLOTS}")
    place = [_number(f"{name}/offset") % slots for name in shards]
    skip = [_number(f"{name}/skip") % (slots - 1) + 1 for name in shards] if slots > 2 else [1] * len(shards)
    owner = [-1] * slots
    left = slots
    while True:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % slots
            owner[place[i]] = i
            left -= 1
            if not left:
                return owner


def place(df: DataFrame, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``df`` with the ``slot`` and the ``shard`` of every row; no shuffle."""
    owner = lookup_table(shards, slots)
    rows = [(slot, shards[i]) for slot, i in enumerate(owner)]
    table = df.sparkSession.createDataFrame(rows, "slot int, shard string")
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    slot = (F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint") % slots).cast("int")
    return df.drop("slot", "shard").withColumn("slot", slot).join(F.broadcast(table), "slot")
