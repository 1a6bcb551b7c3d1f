"""Readers: base tables, guarded loads, fixture views, page tables."""
