"""Batch operators: DataFrame(s) in, DataFrame(s) out, no driver collects."""
