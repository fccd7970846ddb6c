"""Readers for delivered files and landed pages."""
