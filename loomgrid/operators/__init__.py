"""Relational operators over messages, frames, signatures, findings and file inventories."""
