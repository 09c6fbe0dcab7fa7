"""Landed responses -> Bronze rows, and the table sinks."""
