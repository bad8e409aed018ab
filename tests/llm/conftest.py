"""Fixtures come from the folder above."""
