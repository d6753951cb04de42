"""promolens: discount-code analytics over social-media captions, on Spark.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver except scalar parameters.
"""

__version__ = "0.1.0"
