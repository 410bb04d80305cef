"""Corpus labelling, agreement statistics and text classification as Spark DataFrame jobs.

Every public operator takes DataFrames and returns DataFrames; nothing runs
until the caller writes or collects the result. The few functions that do run
Spark jobs (model saving, linear fits, streaming queries) say so in their docs.
"""

__version__ = "0.1.0"
