"""pomelo — entity-attribute analytics as Spark DataFrame jobs.

Item-level behaviour tables become sparse per-entity features; labels are
built by joining users, devices and label sources; a binary logistic
regression is fitted and scored; results are evaluated, merged with a
trusted label source, compared across snapshots and published to
day-partitioned tables.  Everything is a DataFrame plan: Catalyst and AQE
choose the physical strategy.

Subpackages
-----------
functions  column expressions (token grammar, date normalisation, recodes)
sources    table scans, day/latest partition readers, test fixtures
operators  the operator catalogue (features, labels, sets, model, metrics,
           merge, compare)
sinks      partition / table overwrite and append writers
plans      the four batch jobs and the registered driver queries
streaming  (the reference runs daily batches only; see its docstring)
"""

__all__ = ["params", "session"]
