from tidemark.plans.cycle import CycleReport, run_cycle
from tidemark.plans.snapshots import Commit, Snapshots

__all__ = ["Commit", "CycleReport", "Snapshots", "run_cycle"]
