"""Trending-content analytics on Spark: Bronze -> Silver -> quality gate -> Gold -> reports."""
