"""DataFrame operators of the map pipeline."""
