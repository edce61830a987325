"""Streams: an extension, as the tables may arrive over time."""
