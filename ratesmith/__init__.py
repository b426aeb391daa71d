"""ratesmith: Spark-native rating-prediction analytics.

Sub-packages:

* ``sources``   – schemas, JSON/CSV scans, prediction sinks, test fixtures
* ``functions`` – scalar column expressions
* ``operators`` – encoders, features, neighbours, blend, models, evaluation
* ``plans``     – end-to-end pipelines and the registered query set
* ``streaming`` – incremental scoring of arriving pair files
"""

__version__ = "0.1.0"
