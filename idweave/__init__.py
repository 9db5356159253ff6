"""idweave: cleaning, counting and identity resolution of entity data on Spark.

Subpackages: ``functions`` (column expressions), ``sources`` (scans, cells,
writers), ``operators`` (DataFrame operators), ``plans`` (views, pipelines,
query catalogue, oracle SQL), ``llm`` (operators of a training-data pipeline).
"""

__version__ = "0.1.0"
