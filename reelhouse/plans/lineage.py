"""Models run in the order of their lineage, side by side where they do not need each other."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Made = TypeVar("Made")
#: Models that run at a time. Each has jobs of its own; more would only wait for the same cores.
AT_ONCE = 8


def run_in_order(
    spark: SparkSession,
    models: Mapping[str, Callable[[], Made]],
    needs: Mapping[str, set[str]],
    at_once: int = AT_ONCE,
) -> dict[str, Made]:
    """Run every model once those that it needs are done, and return what each made.

    Needs that are not among the models count as done. A model that fails stops only those that
    need it, directly or not. The first failure is raised at the end, and its notes name the other
    models that failed and those that were not run. With `spark.scheduler.mode=FAIR` each model
    has a pool of its own, so that a small one does not wait for a large one's tasks.
    """
    waiting = {name: set(needs.get(name, ())) & set(models) for name in models}
    made: dict[str, Made] = {}
    failed: dict[str, BaseException] = {}
    running: dict[Future, str] = {}

    def run(name: str):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return models[name]()

    with ThreadPoolExecutor(max(1, at_once)) as threads:
        while waiting or running:
            ready = [name for name, needed in waiting.items() if needed <= made.keys()]
            for name in ready:
                del waiting[name]
                running[threads.submit(inheritable_thread_target(spark)(run), name)] = name
            if not running:
                break
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                error = done.exception()
                if error is None:
                    made[name] = done.result()
                else:
                    failed[name] = error
    if failed:
        first = next(iter(failed))
        error = failed.pop(first)
        error.add_note(f"in {first}")
        for name, other in failed.items():
            error.add_note(f"failed too: {name} ({other})")
        if waiting:
            error.add_note(f"not run: {', '.join(waiting)}")
        raise error
    return {name: made[name] for name in models}
