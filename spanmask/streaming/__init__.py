"""Structured Streaming hops: raw -> analysed -> anonymised."""
