"""Named queries over the driver tables, each with its oracle SQL."""
