"""Derived views, pipelines, the query catalogue and its oracle SQL."""
