"""Queries over the supplied tables, and the SQL that states what each must return."""
