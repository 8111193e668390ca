"""The library's queries on the driver's tables, and the SQL each must equal."""
