"""Structured Streaming forms of the record pipeline (an extension: there is no stream in a batch application)."""
