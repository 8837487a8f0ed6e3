"""Jobs: log analysis and the warehouse marts."""
