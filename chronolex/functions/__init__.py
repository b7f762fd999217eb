"""Column functions: normalisation, identifiers, topic rows."""
