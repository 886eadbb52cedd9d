"""Whole plans: reconciliation and marts."""
