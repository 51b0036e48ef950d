"""gridloom: spreadsheet-shaped data to clean relations, as Spark jobs."""
