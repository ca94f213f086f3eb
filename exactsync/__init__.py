"""Exact, auditable batch copies between tables, expressed as Spark plans."""

from exactsync.errors import SyncError
from exactsync.plans.job import SyncJob
from exactsync.plans.mapping import TargetColumn, plan_mapping
from exactsync.sinks.dataset import ParquetTarget
from exactsync.sources.split import KeyLayout, RangeSplit
from exactsync.sources.table import Parameter, Source

__all__ = [
    "Parameter",
    "KeyLayout",
    "ParquetTarget",
    "RangeSplit",
    "Source",
    "SyncError",
    "SyncJob",
    "TargetColumn",
    "plan_mapping",
]
