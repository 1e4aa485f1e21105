"""Readers: text lines, the dated archive, Kafka, registry files and object-store settings."""
