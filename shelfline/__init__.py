"""shelfline: retail demand and inventory analytics as PySpark jobs.

Every operator is a function from DataFrame to DataFrame.  ``operators`` holds
the analytics, ``functions`` the column expressions and the ordered building
blocks they share, ``sources`` the readers, writers and table adapters,
``streaming`` the Structured Streaming jobs, and ``plans`` the pipelines and
the registered queries.
"""
