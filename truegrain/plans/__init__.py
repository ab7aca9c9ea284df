"""From a data dictionary to rules, and from rules to a status report."""
