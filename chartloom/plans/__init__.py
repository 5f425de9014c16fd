"""Document plans: dimensions, the documents, their target form, rebuild and nightly sync."""
