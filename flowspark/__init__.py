"""Cleaning, sampling, profiling and classification of network-flow records on Spark."""
