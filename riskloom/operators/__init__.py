"""Building blocks that hold at any key distribution."""
