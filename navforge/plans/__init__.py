"""Assembled runs: the written pipeline, the lazy query chain, the registry and its oracle."""
