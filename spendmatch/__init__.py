"""spendmatch — Spark-native certified-spend ingestion and analytics.

Every operator takes and returns :class:`pyspark.sql.DataFrame` objects built
from native column expressions, joins, windows and aggregations, so Catalyst
plans the whole chain and nothing passes through the driver.

Sub-packages
------------
functions   column-expression builders (name canonicalisation, hashing, keys,
            fixed-width field extraction, certified-spend formulas)
sources     readers and writers (tables, fixed-width text, fixture recipes)
operators   DataFrame -> DataFrame operators (ingest cleaning, joins and the
            match cascade, change-data sync, data-quality reports, profiling)
plans       the certified-spend marts composed from the operators
streaming   incremental (file-stream) variant of the fixed-width conversion
"""

from spendmatch.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
