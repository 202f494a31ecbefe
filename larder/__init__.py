"""Recipe analytics and data quality as plain Spark jobs.

Every operator is a function ``DataFrame -> DataFrame`` (usable with
``DataFrame.transform``) or a function ``Column -> Column``; nothing here keeps
global state, starts a session or runs Python per row.
"""
