"""Typed sources and sinks, the table catalog, and the adapter from generic sales tables."""
