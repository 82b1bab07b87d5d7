"""Running totals over a whole table in a global order."""

from corpusloom.operators.ranges import running_totals

__all__ = ["running_totals"]
