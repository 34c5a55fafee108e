"""Operators: functions from DataFrames to DataFrames, lazy, without actions."""
