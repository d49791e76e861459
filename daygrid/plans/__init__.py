"""The tables and reports, composed from the operators."""
