"""aidspark: a Spark-native engine for public-grant (State aid) registers.

Layers:

* ``sources``   - damaged XML dumps -> typed rows (splittable text scan, repair
                  expressions, ``from_xml``), Parquet layer readers, driver-table
                  stand-ins.
* ``functions`` - column expressions (text repair, number/date parsing, money
                  arithmetic with engine-independent rounding, NACE sections).
* ``operators`` - flatten, conform, keep-last dedup, clean layer, marts,
                  analyst queries, cross-dataset joins, quality gates, catalog.
* ``plans``     - multi-step jobs: yearly overwrite, upsert, rebuild, publish.
* ``streaming`` - incremental load with Structured Streaming.

Everything is DataFrame -> DataFrame on built-in functions; no Python UDF in
the data path.
"""

from aidspark.session import get_session, prepare, scratch_dir

__all__ = ["get_session", "prepare", "scratch_dir"]
