"""Table checks, cleaning, profiling and matching as lazy Spark plans."""

from rowproof.config import AddressConfig, DatasetConfig, load_registry, resolve_config

__all__ = ["AddressConfig", "DatasetConfig", "load_registry", "resolve_config"]
