"""The reports, each a lazy DataFrame plan."""
