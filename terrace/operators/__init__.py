"""DataFrame → DataFrame operators of the medallion model."""
