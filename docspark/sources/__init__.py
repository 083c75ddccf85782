"""Readers and writers of the record stores."""
