"""Transaction-monitoring reports as PySpark DataFrames.

Every report is a function of its tables and an explicit clock (``as_of``); nothing reads the wall
clock, so a report can be replayed for any moment.
"""
