"""Building blocks for plans that hold at scale, and the end-to-end jobs."""
