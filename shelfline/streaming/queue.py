"""A priority queue of reorder requests that lasts: appended requests, and dequeues that are on record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.functions.ordering import with_position
from shelfline.sources.readers import path_exists

# Up to here the planner keeps the first n of each task; beyond, places come from a range sort.
_TOP = 10_000


def _order() -> list[Column]:
    return [F.col("urgency").desc(), F.col("seq")]


class ReorderQueue:
    """Requests (``seq``, ``urgency`` and any other columns) in a shared folder.

    The most urgent request goes first, equal ones by ``seq``, which is unique.  Each call has a
    number; a call that is on record is not done again but gives the same answer, so whoever lost
    an answer asks again.  A call without a record left nothing that counts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _done(self, kind: str, call: int) -> bool:
        return path_exists(self.spark, f"{self.path}/{kind}/call={call}/_SUCCESS")

    def _all(self, kind: str) -> DataFrame | None:
        """The rows of all calls on record."""
        jvm, root = self.spark.sparkContext._jvm, f"{self.path}/{kind}"
        if not path_exists(self.spark, root):
            return None
        place = jvm.org.apache.hadoop.fs.Path(root)
        listed = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
        calls = [int(f.getPath().getName().split("=")[1]) for f in listed if f.getPath().getName().startswith("call=")]
        done = [f"{root}/call={c}" for c in sorted(calls) if self._done(kind, c)]
        return self.spark.read.option("basePath", root).parquet(*done) if done else None

    def enqueue(self, requests: DataFrame, call: int) -> None:
        if not self._done("requests", call):
            requests.write.mode("overwrite").parquet(f"{self.path}/requests/call={call}")

    def waiting(self) -> DataFrame | None:
        """Requests that no dequeue has taken; none at all (None) before the first enqueue."""
        requests, taken = self._all("requests"), self._all("taken")
        if requests is None:
            return None
        requests = requests.drop("call")
        return requests if taken is None else requests.join(taken.select("seq"), "seq", "left_anti").select(*requests.columns)

    def dequeue(self, n: int, call: int) -> DataFrame | None:
        """The next ``n`` requests (fewer if there are no more) with their ``dispatch_order`` from 1 over all calls."""
        record = f"{self.path}/taken/call={call}"
        if not self._done("taken", call):
            waiting, taken = self.waiting(), self._all("taken")
            if waiting is None:
                return None
            before = 0 if taken is None else taken.count()
            first = waiting.orderBy(*_order()).limit(n) if n <= _TOP else waiting
            placed = with_position(first, _order(), name="dispatch_order").filter(F.col("dispatch_order") < n)
            placed.withColumn("dispatch_order", (F.col("dispatch_order") + 1 + before).cast("long")).write.mode("overwrite").parquet(record)
        return self.spark.read.parquet(record)

    def dispatched(self) -> DataFrame | None:
        """All requests that were taken, with their ``dispatch_order`` and ``call``."""
        return self._all("taken")
