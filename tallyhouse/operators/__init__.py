"""Operators: functions from DataFrames to a DataFrame, without side effects."""
