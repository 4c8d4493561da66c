"""Table writes, run reports, the two jobs and the driver queries."""
