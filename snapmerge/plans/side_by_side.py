"""Datasets that run side by side on one Spark application (G-10).

Each dataset gets a thread with a session of its own (same settings, so that a merge that sets shuffle partitions does not touch another
dataset's plan), a FAIR scheduler pool and a job tag.  Small datasets then finish while a large one still runs, instead of waiting
behind its tasks; :meth:`SideBySide.cancel` stops the jobs of one dataset, and nothing it has not committed yet becomes visible.  The other
datasets go on.  Pools share the executors only with ``spark.scheduler.mode=FAIR`` (set by :func:`snapmerge.session.build_session` where the
cluster has not set it); otherwise jobs of all datasets queue in the order they come.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from ..sources.store import TableStore
from .runner import RunReport


def own_session(spark: SparkSession) -> SparkSession:
    """A session on the same application with the settings of ``spark``."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.get(k, None) != v:
            own.conf.set(k, v)
    return own


class SideBySide:
    def __init__(self, spark: SparkSession, store_root: str, at_once: int):
        self.spark, self.root, self.at_once = spark, store_root, at_once
        self._tag = f"snapmerge-{uuid.uuid4().hex}"
        self._cancelled: set[str] = set()
        self._started: set[str] = set()
        self._changed = threading.Condition()

    def tag(self, dataset: str) -> str:
        return f"{self._tag}-{dataset}"

    def cancel(self, dataset: str) -> None:
        """Stop one dataset: its running jobs end, later ones do not start, what it has not committed stays invisible."""
        with self._changed:
            self._cancelled.add(dataset)
        self.spark.sparkContext.cancelJobsWithTag(self.tag(dataset))

    def wait_for(self, dataset: str) -> None:
        """Until the dataset's thread has started."""
        with self._changed:
            self._changed.wait_for(lambda: dataset in self._started)

    def run(self, datasets: list[str], work: Callable[[TableStore, str], list[RunReport]]) -> list[RunReport]:
        """``work(store, dataset)`` for each dataset, ``at_once`` of them at a time; reports in the order of ``datasets``."""
        with ThreadPoolExecutor(self.at_once, thread_name_prefix="snapmerge") as pool:
            return [r for reports in pool.map(lambda d: self._one(d, work), datasets) for r in reports]

    def _one(self, dataset: str, work: Callable[[TableStore, str], list[RunReport]]) -> list[RunReport]:
        sc = self.spark.sparkContext
        sc.setLocalProperty("spark.scheduler.pool", dataset)
        sc.addJobTag(self.tag(dataset))
        try:
            with self._changed:
                self._started.add(dataset)
                self._changed.notify_all()
            store = TableStore(own_session(self.spark), self.root)
            store.cancelled = lambda: dataset in self._cancelled
            return work(store, dataset)
        finally:  # the thread takes the next dataset
            sc.removeJobTag(self.tag(dataset))
            sc.setLocalProperty("spark.scheduler.pool", None)
