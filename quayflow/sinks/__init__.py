"""Outputs; all of them write from the executors."""
