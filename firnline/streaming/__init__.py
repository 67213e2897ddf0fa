"""Structured Streaming jobs."""

from firnline.session import ship_package

ship_package()
