"""Relational operators shared by the batch jobs and the streams."""
