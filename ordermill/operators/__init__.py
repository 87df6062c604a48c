"""DataFrame-to-DataFrame operators: cleaning, quality checks, splitting of large groups."""
