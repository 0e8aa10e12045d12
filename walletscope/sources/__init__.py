"""Inputs: tables, transaction pages, holder lists, event messages, metric samples."""
