"""Outputs: messages, event and state tables, alert lines, audit lines, samples."""
