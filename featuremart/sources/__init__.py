"""Input tables: from the catalog, or as views over the test tables."""
