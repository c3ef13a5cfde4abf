"""Readers, writers, file manifests and the sample generator."""
