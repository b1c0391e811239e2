"""Motorsport timing analytics on Spark: leaderboards, lap enrichment, race alerts and replay timelines."""
