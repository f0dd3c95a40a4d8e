"""Ribosome-profiling and proteogenomics analytics expressed as Spark DataFrame jobs."""
