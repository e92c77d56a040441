"""Layout parsers: table functions that turn one matrix of cells into price rows."""
