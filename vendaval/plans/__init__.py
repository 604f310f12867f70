"""Layers composed from operators: raw, clean, marts, reports."""
