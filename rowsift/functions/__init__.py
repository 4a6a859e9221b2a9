"""Column helpers and the distributed ranking primitives the operators share."""
