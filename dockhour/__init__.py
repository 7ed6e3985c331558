"""dockhour — hourly station demand analytics on Spark.

Every operator takes and returns a lazy ``pyspark.sql.DataFrame``; nothing
collects data to the driver.  Sub-packages:

* ``functions``  column expressions (keys, time parts, calendar, geometry)
* ``sources``    readers, sinks and the testdata views
* ``operators``  aggregates, grids, joins, splits, encodings, spatial, scoring, EDA
* ``plans``      end-to-end compositions (targets builder, training table, splits,
                 leaderboard, city enrichment)
* ``ml``         MLlib count models and the missingness-aware ensemble
* ``streaming``  the demand count as a Structured Streaming query
"""

__version__ = "0.1.0"
