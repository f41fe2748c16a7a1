"""DataFrame operators (batch and streaming unless stated)."""
