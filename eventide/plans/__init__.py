"""Registered queries: the reference jobs' computations over the supplied tables."""
