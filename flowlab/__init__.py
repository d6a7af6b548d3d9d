"""flowlab: cleaning, profiling, features, models and model comparison for labelled flow tables.

Every operator takes and returns DataFrames and is made of built-in Spark expressions, so one
plan goes through Catalyst from scan to result. Nothing here creates a session, sets a session
option or hard-codes a path: the caller owns both.
"""
