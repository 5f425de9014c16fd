"""Table scans, keyed tables with batches, document databases, change topics."""
