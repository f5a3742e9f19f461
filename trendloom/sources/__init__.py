"""Readers and writers of the stored tables and documents."""
