"""Running independent Spark jobs side by side from driver threads."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor


def concurrently(tasks: list) -> list:
    """Run independent jobs (callables) in driver threads; Spark schedules
    their tasks together. Returns results in order; re-raises the first error
    after all have finished."""
    if not tasks:
        return []
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(t) for t in tasks]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e
    return [f.result() for f in futures]
