"""The daily job around the batch plan: a validated budget, retries, a safe failure record, and the audit row that insight.run_audit() reads."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store
from ..operators.discover import Budget
from . import batch

BUDGET = "SERP_DAILY_REQUEST_LIMIT"


def budget(env: Mapping[str, str], name: str = BUDGET) -> Budget:
    """The day's search budget: unset or blank is 0, anything but a non-negative integer is refused."""
    text = (env.get(name) or "0").strip() or "0"
    if not text.isdecimal():
        raise ValueError(f"{name} is a non-negative integer, not {text!r}")
    return Budget(int(text))


def retried(call: Callable, tries: int = 3, wait: float = 15.0, when: Callable[[Exception], bool] = lambda e: True, sleep: Callable[[float], None] = time.sleep):  # noqa: ANN201
    """call(), again after wait, 2 wait, ... seconds if it raises what when accepts; the last error is raised."""
    for n in range(1, tries + 1):
        try:
            return call()
        except Exception as e:
            if n == tries or not when(e):
                raise
            sleep(wait * n)


def over_quota(e: Exception) -> bool:
    return "429" in str(e)


def safely(call: Callable) -> dict:
    """{status: ok, result} or, whatever is raised, {status: failed_safe_mode, error}."""
    try:
        return {"status": "ok", "result": call()}
    except Exception as e:
        return {"status": "failed_safe_mode", "error": str(e)}


def daily(spark: SparkSession, discovered: DataFrame, fetches: DataFrame, store_path: str, log_path: str, as_of: str, now: str, queries: int) -> dict:
    """Runs the batch, appends its audit row, and returns the counts with the reason."""
    counts = batch.run(spark, discovered, fetches, store_path, F.lit(as_of).cast("date"), F.lit(now))
    why = batch.reason(spark, counts)
    notes = f"Queries={queries} | Qualified={counts['found']} | Saved={counts['saved']} | Duplicates={counts['duplicates']} | Failed={counts['failed']} | Reason={why}"
    store.activity(spark, log_path, now, "SYSTEM", "DAILY_RUN", counts["saved"], notes)
    return counts | {"reason": why}
