"""DataFrame operators. Column names are arguments; the defaults are the tables' own."""
