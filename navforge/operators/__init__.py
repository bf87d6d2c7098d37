"""DataFrame operators of the silver, gold and ops layers."""
