"""shelfwise: multi-source product catalogue analytics as Spark DataFrame jobs.

Every public function takes DataFrames (or Columns) and returns lazy DataFrames
(or Columns); nothing in a transform calls ``collect`` or ``count``.
"""
