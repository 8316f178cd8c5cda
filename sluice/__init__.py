"""sluice: bounded incremental batch pipelines on Spark DataFrames.

Every public function is a plain ``DataFrame -> DataFrame`` (or
``Column -> Column``) transformation built from built-in Spark SQL
functions, so Catalyst plans the whole batch as one query.
"""

__version__ = "0.1.0"
