"""Readers and writers: JSON collections, sitemaps, page artifacts, bridges over relational tables."""
