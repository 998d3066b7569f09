"""Runnable jobs over tables of any place that Spark reads, with a command line and a config file each."""
