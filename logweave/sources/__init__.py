"""Reading topic logs: selection, start positions, isolation."""
