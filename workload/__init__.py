"""Queries of the library over the star-schema test tables, with SQL for comparison."""
