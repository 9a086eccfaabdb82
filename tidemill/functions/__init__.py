"""Column functions: identifiers, time conversion, buckets, JSON."""
