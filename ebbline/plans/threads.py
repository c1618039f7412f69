"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
THREADS = 4


def concurrently(spark: SparkSession, jobs: dict[Hashable, Callable[[], T]], threads: int = THREADS) -> dict[Hashable, T]:
    """The results of ``jobs``. At most ``threads`` run at a time, each in a scheduler pool of its own, so that under the fair scheduler a
    long fit does not hold up the short ones. The first error is raised when the running jobs have ended; the others are not started."""

    def run(name: Hashable, job: Callable[[], T]) -> T:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"job-{name}")
        return job()

    inherited = inheritable_thread_target(spark)  # job groups and tags of the caller
    with ThreadPoolExecutor(max_workers=threads) as executor:
        futures = {name: executor.submit(inherited(run), name, job) for name, job in jobs.items()}
        try:
            return {name: future.result() for name, future in futures.items()}
        except BaseException:
            for future in futures.values():
                future.cancel()
            raise
