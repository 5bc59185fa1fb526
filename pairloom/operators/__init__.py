"""DataFrame operators; each is lazy and runs no action."""
