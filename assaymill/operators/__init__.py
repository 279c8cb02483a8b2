"""Table-level operators: functions from DataFrames to DataFrames."""
