"""Runs that chain operators with gates and sinks."""
