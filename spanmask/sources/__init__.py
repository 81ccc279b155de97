"""Sources and sinks: JSON landing, file lineage, hop tables, catalog inventory, synthetic data."""
