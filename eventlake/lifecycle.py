"""Clean-up of ingested data: a plan that does nothing until it is confirmed."""

from __future__ import annotations

from dataclasses import dataclass, field

from eventlake.plans.state import StateStore
from eventlake.tables import Catalog


@dataclass
class Cleanup:
    """What would go: tables, paths (Bronze, checkpoints, marts, landing) and refresh states."""

    catalog: Catalog
    states: StateStore
    paths: list[str] = field(default_factory=list)

    def plan(self) -> list[str]:
        return [f"table {t}" for t in self.catalog.list()] + [f"path {p}" for p in self.paths] + [f"state {job}" for job in self.states.jobs()]

    def run(self, confirm: bool = False) -> list[str]:
        """The plan; carried out only with ``confirm``.  Paths that are gone already are passed over."""
        plan = self.plan()
        if confirm:
            for name in self.catalog.list():
                self.catalog.table(name).drop()
            for p in self.paths:
                at = self.catalog.spark._jvm.org.apache.hadoop.fs.Path(p)
                at.getFileSystem(self.catalog.spark._jsc.hadoopConfiguration()).delete(at, True)
            self.states.clear()
        return plan
