"""Readers, landing of nested market data, and sinks."""
