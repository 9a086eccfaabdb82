"""Rollups kept up to date from a stream."""
