"""engram: a Spark-native temporal knowledge-memory engine.

Text becomes tiered, namespaced episodes; episodes carry typed entities and
time-valid facts; questions are answered by hybrid retrieval; maintenance jobs
compact, audit and report. Every operator is a DataFrame -> DataFrame function.
"""

__version__ = "0.1.0"
