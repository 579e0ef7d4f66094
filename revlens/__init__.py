"""revlens: product-review analytics and recommendation as Spark plans.

Every public function takes and returns Spark DataFrames (or Columns); none of
them collects review rows to the driver.  Sub-packages:

* ``sources``   - raw review dumps, CSV / parquet tables, exports, the test view
* ``functions`` - Column-level helpers (dates, text, numbers, fuzzy score)
* ``operators`` - DataFrame -> DataFrame operators (clean, rank, summarise, ...)
* ``plans``     - end-to-end jobs that chain operators (ingest, dashboard, ...)
* ``streaming`` - incremental ingest of raw dumps with Structured Streaming
"""

from revlens.schema import REVIEW_COLUMNS, REVIEW_SCHEMA

__all__ = ["REVIEW_COLUMNS", "REVIEW_SCHEMA"]
__version__ = "0.1.0"
