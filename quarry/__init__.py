"""quarry — event quality and anomaly analytics on Spark.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver except bounded, size-checked artefacts (a one-row
statistic, the trained forest).
"""

__version__ = "0.1.0"
