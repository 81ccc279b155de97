"""Training-data operators: deduplication, filtering, extraction and token output on Spark."""
