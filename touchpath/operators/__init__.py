"""DataFrame -> DataFrame operators (the models of the attribution chain)."""
