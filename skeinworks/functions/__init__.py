"""Scalar functions: expressions where Catalyst can plan them, Arrow-batched Python where it cannot."""
