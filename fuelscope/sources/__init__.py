"""Readers and writers of observation tables."""
