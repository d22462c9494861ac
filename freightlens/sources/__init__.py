"""Files in and out: landing CSV, name lists, warehouse tables."""
