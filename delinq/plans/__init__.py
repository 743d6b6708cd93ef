"""End-to-end jobs built from the operators, and the table of registered queries."""
