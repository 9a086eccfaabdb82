"""Queries that apply the engine's operators to whole tables, each with the SQL it is checked against."""
