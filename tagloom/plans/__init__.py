"""Jobs and registered queries."""
