"""Statements and callables run once, in order, before or after the transfer."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from exactsync.errors import SyncError

Hook = str | Callable[[SparkSession], None]


def run_hooks(spark: SparkSession, hooks: Iterable[Hook]) -> None:
    """The first failure stops the rest; a lost reply leaves the effects unknown."""
    for hook in hooks:
        try:
            if isinstance(hook, str):
                # Run it through without bringing its rows to the driver.
                spark.sql(hook).write.format("noop").mode("overwrite").save()
            else:
                hook(spark)
        except (TimeoutError, ConnectionError) as e:
            raise SyncError.unknown("Hook response was lost; its effects must be checked") from e
        except SyncError:
            raise
        except Exception as e:
            raise SyncError("HOOK", str(e).splitlines()[0]) from e
