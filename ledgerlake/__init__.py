"""ledgerlake: a Spark-native retail-bank customer analytics pipeline.

Raw landing files become typed staging tables, period-partitioned
published tables, three customer marts and a keyed export.  Every
operator is a DataFrame -> DataFrame function (sinks return the
read-back of what they wrote), so Catalyst plans the whole pipeline.
"""

__version__ = "0.1.0"
