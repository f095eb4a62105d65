"""Column helpers and the distributed building blocks the operators share."""
