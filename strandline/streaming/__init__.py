"""Streaming forms: chunk framing with carried state, and running collapse."""
