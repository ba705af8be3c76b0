"""Readers and the raw forms they produce."""
