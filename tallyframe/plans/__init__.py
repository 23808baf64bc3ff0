"""SQL and the registered queries."""
