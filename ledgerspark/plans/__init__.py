"""Registered queries of the telemetry jobs and their SQL twins."""
