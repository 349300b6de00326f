"""Independent Spark actions submitted side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

THREADS = 6


def run_together(spark: SparkSession, tasks: Sequence[Callable[[], Any]], threads: int = THREADS) -> list[Any]:
    """Runs driver-side steps in threads, so that small jobs share the cluster.

    All steps are finished before the first error, if any, is raised.
    """
    if not tasks:
        return []
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(tasks)))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    return [r.result() for r in running]
