"""DataFrame operators: scan, anonymise, summary, long forms, gazetteer."""
