"""Streaming forms: the same batch functions inside foreachBatch, and stateful operators."""
