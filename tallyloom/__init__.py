"""Commerce warehouse jobs, metrics and table checks written on the PySpark API."""
