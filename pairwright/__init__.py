"""Spark-native building blocks for AI-feedback preference data.

Every public function takes and returns DataFrames or Columns; nothing here
starts a job unless its docstring says so.
"""

__version__ = "0.1.0"
