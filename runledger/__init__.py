"""Compute-usage analytics over tables of job runs, clusters and pools."""
