"""Jobs for spark-submit: ``python -m flowspark.jobs.<name> --help``."""
