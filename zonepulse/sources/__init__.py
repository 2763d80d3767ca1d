"""Readers, samplers and writers."""
