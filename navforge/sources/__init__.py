"""Readers, fixture derivation and table sinks."""
