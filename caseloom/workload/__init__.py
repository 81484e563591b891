"""The library applied to the test tables: every registered query and its SQL counterpart."""
