"""DataFrame -> DataFrame operators over long tables."""
