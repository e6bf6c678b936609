"""Composition of the operators into the revenue model, the query registry
and the equivalent SQL used as an oracle."""
