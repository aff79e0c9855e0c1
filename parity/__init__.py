"""Registered queries over the driver's tables and the SQL each must agree with."""
