"""Configured instances: the traffic and roads feeds and their layer runs."""
