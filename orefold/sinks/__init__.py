from orefold.sinks.files import write_csv
from orefold.sinks.lake import Lake, Snapshot

__all__ = ["Lake", "Snapshot", "write_csv"]
