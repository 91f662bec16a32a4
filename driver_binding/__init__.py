"""Binds the driver's tables to the visit model: views, registered queries, oracle texts."""
