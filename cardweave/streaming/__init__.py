"""Structured Streaming drivers of the batch jobs."""
