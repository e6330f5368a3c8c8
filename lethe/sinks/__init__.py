from lethe.sinks.catalog import PartitionError, add_partition, drop_partition, drop_partitions
from lethe.sinks.writers import convert, save

__all__ = ["PartitionError", "add_partition", "convert", "drop_partition", "drop_partitions", "save"]
