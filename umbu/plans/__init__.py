"""Bronze, silver and gold tables as frame-to-frame functions, and their runs."""
