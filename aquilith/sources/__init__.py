"""Logs, tables and fixtures."""
