"""Driver-side looks at results: always bounded, always opt-in."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame

T = TypeVar("T")


def preview(df: DataFrame, n: int = 10, truncate: bool = True) -> None:
    """Print ``n`` rows. It runs the plan again, so call it only when wanted."""
    df.show(n, truncate=truncate)


def timed(action: Callable[[], T]) -> tuple[T, float]:
    """Run ``action`` and return (result, elapsed seconds)."""
    start = time.perf_counter()
    result = action()
    return result, time.perf_counter() - start


def run_noop(df: DataFrame) -> None:
    """Execute the whole plan without keeping the rows (benchmarks)."""
    df.write.format("noop").mode("overwrite").save()
