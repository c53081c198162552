"""Readers. Each returns a lazily evaluated frame; schema samples are all they bring to the driver."""
