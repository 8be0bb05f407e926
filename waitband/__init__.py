"""waitband: banded waiting-list analytics on Spark.

Generic, configuration-driven DataFrame operators for wide "banded count"
extracts (one column per week-of-wait band), plus a preset that wires them
into a monthly standard-compliance pipeline: staging, intermediate metrics,
fact table, data-quality suite, idempotent month loads, SCD2 history,
published analyst queries, distribution features and models.
"""

__version__ = "0.1.0"
