"""Readers that turn files of several formats into one block model."""
