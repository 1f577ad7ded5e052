"""DataFrame-to-DataFrame steps; all of them also accept streaming frames unless noted."""
