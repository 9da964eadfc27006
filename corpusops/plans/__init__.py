"""Registered queries: each pairs a Spark plan with the SQL it must agree with."""
