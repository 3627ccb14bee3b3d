"""fundscope: Spark-native cleaning, profiling and text-classification jobs
for a table of crowdfunding campaigns.

Every operator takes and returns a ``DataFrame`` (or a ``pyspark.ml``
estimator / model) and keeps its work inside Catalyst expressions or
distributed MLlib stages.
"""

__version__ = "0.1.0"
