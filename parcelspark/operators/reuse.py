"""Intermediate results that one report reads several times."""

from __future__ import annotations

import weakref

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, functions as F

from parcelspark.operators.lookup import Keys, key_list


class Kept:
    """Persisted frames of one owner."""

    _owners: weakref.WeakSet[Kept] = weakref.WeakSet()

    def __init__(self) -> None:
        self._frames: list[DataFrame] = []
        Kept._owners.add(self)

    def keep(self, df: DataFrame) -> DataFrame:
        """Persist a small intermediate that several branches of a report read. Lost blocks are
        recomputed from the plan. `release` frees it."""
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._frames.append(kept)
        return kept

    def counted(self, df: DataFrame, key: str) -> tuple[DataFrame, Keys]:
        """Keep a frame now, with the list of its keys: rows and bytes of the keys are observed while it is made, so
        that no job counts them."""
        seen = Observation()
        size = F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0))
        kept = self.keep(df.observe(seen, F.count("*").alias("rows"), size.alias("bytes")))
        kept.write.format("noop").mode("overwrite").save()
        return kept, key_list(kept, key, seen.get["rows"], seen.get["bytes"])

    def release(self) -> None:
        while self._frames:
            self._frames.pop().unpersist()


def release() -> None:
    """Free what all reports keep, of every `Tables`: for a session that runs no other report."""
    for owner in list(Kept._owners):
        owner.release()
