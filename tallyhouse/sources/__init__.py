"""Reading raw and published tables, writing results."""
