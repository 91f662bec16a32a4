"""Readers and writers: staged visits, lookups, warehouse tables, work folders."""
