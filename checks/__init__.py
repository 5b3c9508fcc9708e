"""Queries over the warehouse tables with the SQL that has to give the same rows."""
