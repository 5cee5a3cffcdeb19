"""Configured jobs (one config record per exchange) and the query catalog."""
