"""DataFrame -> DataFrame operators; import them from their modules."""
