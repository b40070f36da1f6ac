"""Profiles, workflow, lineage and the query catalogue."""
