"""Catalogs (YAML -> sections) and the batch runner over all sections."""
