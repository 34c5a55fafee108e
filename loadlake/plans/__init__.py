"""Whole jobs composed of operators, and the workload over the sample tables."""
