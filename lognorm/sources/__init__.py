"""Where records come from: raw log files, definition files, dead letters, driver tables."""
