"""DataFrame operators on price bars."""
