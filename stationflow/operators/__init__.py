"""DataFrame -> DataFrame operators over observations."""
