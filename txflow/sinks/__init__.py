"""Writers: landing, quarantine, graph tables, topics, reports."""
