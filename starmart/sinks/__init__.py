"""Writing: landing files, tables, views, histories, sessions and result snapshots."""

from .files import save_result, write_landing
from .history import History
from .sessions import SessionTable
from .store import Store, namespace_for

__all__ = ["History", "SessionTable", "Store", "namespace_for", "save_result", "write_landing"]
