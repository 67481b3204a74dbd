"""DataFrame -> DataFrame operators. Stored tables are left to ``plans``; at most an
intermediate result is staged."""
