"""Several sources extracted for one transform.

Spark DataFrames are lazy: building them costs nothing, and independent scans
inside one plan run in parallel on the executors, so no thread pool is needed
for a single action. When several independent *actions* (loads) must run at
once, ``run_concurrently`` submits them from inheritable threads so they share
the session (use FAIR scheduler pools to share executors evenly).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import InheritableThread


def extract_all(sources: Mapping[str, Callable[[], object]]) -> dict:
    """Build every source frame (lazily); failures raise with the source name."""
    out = {}
    for name, make in sources.items():
        try:
            out[name] = make()
        except Exception as e:  # noqa: BLE001
            raise RuntimeError(f"source {name!r} failed: {e}") from e
    return out


def run_concurrently(actions: Mapping[str, Callable[[], object]], pool: str | None = None) -> dict:
    """Run independent actions at the same time; returns name -> result and
    re-raises the first failure after all have finished."""
    results, errors = {}, {}

    def runner(name, fn, sc):
        if pool and sc is not None:
            sc.setLocalProperty("spark.scheduler.pool", pool)
        try:
            results[name] = fn()
        except Exception as e:  # noqa: BLE001
            errors[name] = e

    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    threads = [InheritableThread(target=runner, args=(n, f, sc)) for n, f in actions.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        name, err = next(iter(errors.items()))
        raise RuntimeError(f"action {name!r} failed: {err}") from err
    return results
