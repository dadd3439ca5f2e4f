"""Set operators over event, triple and request tables."""
