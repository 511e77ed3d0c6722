"""Writers."""

from tripstats.sinks.keyed import write_keyed
from tripstats.sinks.text import write_csv

__all__ = ["write_csv", "write_keyed"]
