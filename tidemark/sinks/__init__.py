from tidemark.sinks.ordered import read_ordered, write_ordered
from tidemark.sinks.versioned import VersionedTable
from tidemark.workspace import shared_folder

__all__ = ["VersionedTable", "read_ordered", "shared_folder", "write_ordered"]
