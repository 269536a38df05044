"""Whole jobs built from the operators: table builds, the query API, the measured workload."""
