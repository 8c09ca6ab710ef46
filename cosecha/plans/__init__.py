"""Composed flows: each function builds one output table as a lazy plan."""
