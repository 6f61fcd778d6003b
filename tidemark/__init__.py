"""Landmark-prediction datasets and their evaluation as Spark jobs.

Every public function takes and returns DataFrames (or Columns) and adds lazy
plan nodes only; the few that run a job say so in their docstring.
"""
