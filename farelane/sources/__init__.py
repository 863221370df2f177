"""Where trip rows come from."""
