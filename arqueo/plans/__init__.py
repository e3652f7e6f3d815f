"""Named reports and controls built from the operators, plus the query registry."""
