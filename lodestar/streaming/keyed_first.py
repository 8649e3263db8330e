"""First row per key over a whole stream, kept in keyed state.

The state of a key is the position of its first row so far (the values of the
order columns), in the RocksDB store; the row itself is in the output.  Rows
come as they are, not as pandas cells, so that long integers next to nulls stay exact.  A row of
an earlier position that arrives later takes the key over: the output is an
upsert, and of the rows written for a key the one of the first position counts
(``first_rows``).  A batch reads its own rows and the states of its own keys, so
its cost does not grow with the history.
"""

from __future__ import annotations

import pickle

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestar.operators.dedupe import first_wins

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rank(position: tuple) -> tuple:
    """Sorts positions as Spark does: ascending, nulls first."""
    return tuple((v is not None, v) for v in position)


class FirstRow(StatefulProcessor):
    """Emits the first row of a key whenever a batch brings an earlier one."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "position binary")

    def handleInputRows(self, key, rows, timerValues):
        best, first = pickle.loads(self.first.get()[0]) if self.first.exists() else None, None
        for row in rows:
            at = tuple(row[c] for c in self.order)
            if best is None or rank(at) < rank(best):
                best, first = at, row
        if first is not None:
            self.first.update((pickle.dumps(best),))
            yield first

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """The store that this state needs; a setting of the user's own stays."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(name, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(name, ROCKSDB)


def first_wins_stream(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Upserts of a stream (output mode ``update``): a row of a key replaces the
    one before.  Rows with a null key pass, as they are never duplicates."""
    from pyspark import cloudpickle

    from lodestar.streaming import keyed_first
    cloudpickle.register_pickle_by_value(keyed_first)
    use_rocksdb(df.sparkSession)
    found = df.where(F.col(key).isNotNull()).groupBy(key).transformWithState(
        FirstRow(order), outputStructType=df.schema, outputMode="Update", timeMode="None")
    return found.unionByName(df.where(F.col(key).isNull()))


def first_rows(upserts: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The current rows of what the stream has written."""
    return first_wins(upserts, key, order)
