"""Writers for stored tables."""
