"""Loads that chain sources, operators and sinks, one module per layer."""
