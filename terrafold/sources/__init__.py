"""Readers and writers: derived tables, tile packs, routing graphs, PBF, shapefiles."""
