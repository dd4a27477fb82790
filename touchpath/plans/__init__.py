"""End-to-end plans: the attribution chain and its registered queries."""
