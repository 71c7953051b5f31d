"""gleaner: a PySpark-native engine for mining news, forum and market data.

Every operator is a function from DataFrames to a DataFrame.  Sub-packages:

* ``functions``  column expressions (cleaning rules, URLs, durations, text)
* ``operators``  set-level operators on whole tables
* ``sources``    readers and writers
* ``plans``      whole jobs composed from operators
* ``streaming``  Structured Streaming twins of the incremental operators
* ``catalog``    registered queries with their oracle SQL
"""
