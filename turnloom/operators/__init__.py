"""Operators over chat records: shape adapters, validation, templates, samples, layout."""
