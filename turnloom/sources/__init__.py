"""JSONL sources and sinks and the shared scratch folder."""
