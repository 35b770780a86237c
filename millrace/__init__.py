"""DataFrame operators over governed industrial resource tables."""
