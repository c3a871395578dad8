"""The pool of a country's best owners as the keyed state of a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ranking import POOL_LIMIT, WEIGHTS

#: Rows of one owner: the batch's folded hits, and the pool.
OWNERS = "country string, login string, seq bigint, stars bigint, repository string, confidence string, terms array<string>"
_VALUE = "seq bigint, stars bigint, repository string, confidence string, terms array<string>"


class OwnerPool(StatefulProcessor):
    """State of a country: its best `limit` owners and all that tie with the last one, by login.

    A batch has one row for each owner, see ranking.pool_fold(). Rows are merged as they stream in. An owner whose row has come
    can't come back with this batch, so those below the pool's last one go whenever the pool has grown to twice its limit;
    owners of the state whose row may still come wait until the end.
    """

    def __init__(self, limit: int = POOL_LIMIT) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("owners", "login string", _VALUE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = {k[0]: (v[0], v[1], v[2], v[3], sorted(v[4])) for k, v in self.state.iterator()} if self.state.exists() else {}
        pool, most, waiting = dict(known), 2 * max(self.limit, len(known)), set(known)
        for some in rows:
            for r in some.itertuples(index=False):
                pool[r.login] = self.merged(pool.get(r.login), (int(r.seq), int(r.stars), r.repository, r.confidence, sorted(r.terms)))
                waiting.discard(r.login)
                if len(pool) > most:
                    self.cut(pool, waiting)
                    most = 2 * max(self.limit, len(pool))
        self.cut(pool, set())
        for login in known.keys() - pool.keys():
            self.state.removeKey((login,))
        for login, owner in pool.items():
            if owner != known.get(login):
                self.state.updateValue((login,), owner)
        yield pd.DataFrame([(key[0], login, *owner) for login, owner in pool.items()], columns=["country", "login", "seq", "stars", "repository", "confidence", "terms"])

    def close(self) -> None:
        pass

    def cut(self, pool: dict[str, tuple], waiting: set[str]) -> None:
        if len(pool) > self.limit:
            least = sorted((o[1] for o in pool.values()), reverse=True)[self.limit - 1]
            for login in [k for k, o in pool.items() if o[1] < least and k not in waiting]:
                del pool[login]

    @staticmethod
    def merged(old: tuple | None, new: tuple) -> tuple:
        """Latest fields, strongest attribution (the earlier of equals), all terms, the repository with more stars (the newer)."""
        if old is None:
            return new
        weight = lambda o: WEIGHTS.get(o[3], 0)
        best = new if new[1] >= old[1] else old
        return new[0], best[1], best[2], old[3] if weight(old) >= weight(new) else new[3], sorted({*old[4], *new[4]})


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start in the block keep their state in RocksDB, which keyed state needs; the session stays as it was."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def owner_pools(owners: DataFrame, limit: int = POOL_LIMIT) -> DataFrame:
    """A stream of folded owners to the whole pool of each country that a batch touches."""
    return owners.groupBy("country").transformWithStateInPandas(OwnerPool(limit), OWNERS, "Update", "None")
