"""Chains of operators: the core run, the extension analyses and the dashboard."""
