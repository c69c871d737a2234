"""scenecast: gridded scenes -> time series -> regression models, on Spark.

Every public function takes and returns Spark DataFrames (or MLlib models);
nothing is pulled to the driver except bounded summaries.

Sub-packages
------------
``sources``    listings, scene tables, feature tables, run records, model store
``functions``  column expressions (file-name times, calendar fields, metrics)
``operators``  DataFrame -> DataFrame operators (nearest pick, scene stats,
               lags, splits, scoring, report tables, model fitting)
``plans``      end-to-end jobs built from the operators, plus the query
               catalogue used by ``__spark_entry__``
``streaming``  incremental ingest and scoring with Structured Streaming
"""

from scenecast.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
__version__ = "0.1.0"
