"""Named queries, the period report and the run from files to results."""
