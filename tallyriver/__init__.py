"""Commerce event analytics as DataFrame-to-DataFrame operators on Spark.

The sub-packages:

``functions``  column expressions and aggregate helpers
``sources``    event and table readers
``sinks``      batch writers
``operators``  the operators, each a function on DataFrames
``streaming``  sinks, state and run control for Structured Streaming
``plans``      whole queries built from the operators
"""

__version__ = "0.1.0"
