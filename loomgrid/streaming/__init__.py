"""Structured Streaming forms: recording, sessions, online hold."""
