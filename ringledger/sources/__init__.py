"""Tables in and out: raw files, run state, audit, warehouse tables and SQL."""
