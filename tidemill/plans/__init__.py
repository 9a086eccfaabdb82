"""Plans over the catalogue: chunks, hierarchies, the work queue, refresh windows."""
