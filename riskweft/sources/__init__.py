"""Readers, writers, inspection and model artefacts."""
