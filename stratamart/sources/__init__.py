"""Readers for landing-zone CSV files and stored tables."""
