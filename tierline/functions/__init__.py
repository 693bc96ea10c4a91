"""Pure column, schema and DataFrame -> DataFrame functions."""
