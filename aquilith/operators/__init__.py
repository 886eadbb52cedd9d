"""Relational operators over telemetry rows."""
