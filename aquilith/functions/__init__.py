"""Column functions: units, rules, codec."""
