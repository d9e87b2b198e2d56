"""Files, tables and databases in; files, tables and views out."""
