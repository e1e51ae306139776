"""Readers that turn documents, pages and files into typed tables, and writers."""
