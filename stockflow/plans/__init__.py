"""Whole jobs composed of the operators: gold, mart, views, seeding."""
