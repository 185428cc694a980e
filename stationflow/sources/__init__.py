"""Where observations come from and where results go."""
