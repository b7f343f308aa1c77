"""Readers and writers: dimensions, keyword lists, catalogs, landed pages, logs, checkpoints, reports."""
