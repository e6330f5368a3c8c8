from lethe.sources.config import CONFIG_COLUMNS, clean_config_csv, load_config, typed_config
from lethe.sources.readers import load, load_columns, string_partitions

__all__ = [
    "CONFIG_COLUMNS",
    "clean_config_csv",
    "load",
    "load_columns",
    "load_config",
    "string_partitions",
    "typed_config",
]
