"""Column-level building blocks (Catalyst expressions only, unless a name says ``_udf``)."""
