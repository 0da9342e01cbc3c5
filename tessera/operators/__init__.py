"""Operators: functions ``(DataFrame, ...) -> DataFrame`` for the four
workloads. None collects data to the driver; iterative ones loop over a
parameter-bounded number of steps."""
