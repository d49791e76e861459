"""Readers: dated snapshot files, history files, JSON payloads, file inventories, the catalog."""
