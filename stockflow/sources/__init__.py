"""Readers: message streams, campaign configuration, lake tables."""
