"""Column expressions: recognisers, spans, rewrite, plug-in UDF detectors."""
