"""Wearable-sensor study data on Spark: read, derive, check, summarise, write."""
