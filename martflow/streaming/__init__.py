"""Structured Streaming adapters: stateful processors, jobs and sinks."""
