"""Operators over chunked data: copy, verification, compression, rollups, validation."""
