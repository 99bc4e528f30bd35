"""Queries of the warehouse over the test tables, with equivalent SQL."""
