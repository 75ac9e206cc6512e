"""Several Spark jobs at once, no more than a given number; the first failure ends the others."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def bounded(spark: SparkSession, tasks: Sequence[Callable[[], T]], concurrency: int = 1) -> list[T]:
    """Results of ``tasks`` in order. At most ``concurrency`` run at a time, each in a thread whose Spark jobs carry a common tag.

    When one fails, tasks that haven't begun don't begin, the jobs of the others are
    cancelled by the tag, and the first error is raised once all threads have ended.
    """
    if concurrency < 1:
        raise ValueError("concurrency must be positive")
    context, tag = spark.sparkContext, f"strandline-{uuid.uuid4().hex}"
    stopped, first, lock = threading.Event(), [], threading.Lock()

    def one(task: Callable[[], T]) -> T | None:
        if stopped.is_set():
            return None
        context.addJobTag(tag)
        try:
            return task()
        except BaseException as error:
            with lock:
                first.append(error)
            stopped.set()
            context.cancelJobsWithTag(tag)
            return None
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(concurrency) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(one), tasks))
    if first:
        raise first[0]
    return found
