"""clickseg: clickstream cleaning, buyer features and K-Means segmentation on Spark.

Modules: ``sources`` (readers, writers, S3A), ``functions`` (column expressions),
``operators`` (cleaning, features, quality, clustering, scoring), ``streaming``
(log metrics), ``plans`` (jobs, registered queries, oracle SQL), ``cli``.
"""

__version__ = "0.1.0"
