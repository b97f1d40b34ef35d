"""Structured Streaming over observations that arrive scene by scene."""
