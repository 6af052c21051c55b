"""Operators for preparing training text: filtering, de-duplication, privacy, mixing, packing and archives."""
