"""DataFrame operators: cleanse, merge, normalize, evolve."""
