from lethe.plans.jobs import RunError, RunReport, purge, retain_mask, retain_mask_by_event, run
from lethe.plans.partitions import event_source_partitions, mask_partitions, plan_partitions, purge_partitions

__all__ = [
    "RunError",
    "RunReport",
    "event_source_partitions",
    "mask_partitions",
    "plan_partitions",
    "purge",
    "purge_partitions",
    "retain_mask",
    "retain_mask_by_event",
    "run",
]
