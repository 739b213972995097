"""DataFrame-in, DataFrame-out steps; usable through ``df.transform``."""
