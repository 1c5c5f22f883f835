"""Named queries over the project's tables, each with the SQL that must give the same rows."""
