"""DataFrame operators of the tick lakehouse."""
