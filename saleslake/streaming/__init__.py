"""Picking up landing files as a stream."""
