"""Operators that prepare text and records for training; nothing outside imports them."""
