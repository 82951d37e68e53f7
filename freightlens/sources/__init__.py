"""Reading, normalising, landing and incrementally loading raw tables."""
