"""How ordered work is laid out over partitions."""
from rillframe.plans.keys import match_keys
from rillframe.plans.lineup import Lineup, Run, count_run, last_run, max_run, min_run, sum_run

__all__ = ["Lineup", "Run", "count_run", "last_run", "match_keys", "max_run", "min_run", "sum_run"]
