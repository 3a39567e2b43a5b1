"""Operators for preparing training data at scale.

Nothing outside this subpackage imports it.  Every operator takes DataFrames
and returns DataFrames; columns of the input other than the named ones are
never read, so extra columns and clashing names do no harm.
"""
