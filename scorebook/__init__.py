"""scorebook: a Spark-native pipeline for ball-by-ball match documents.

Every operator is a plain ``DataFrame -> DataFrame`` function that takes column
names as arguments, so it runs on match tables and on any star-schema table.
"""

__version__ = "0.1.0"
