"""Sources (scans, lineage stamping, fixture binding) and sinks."""
