"""Steps written to the shared folder, which ends their lineage and outlives lost executors."""

from __future__ import annotations

from tidewright.session import landed

__all__ = ["landed"]
