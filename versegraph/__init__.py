"""Spark-native engine for structured documents: extraction, alignment, rendering, validation."""
