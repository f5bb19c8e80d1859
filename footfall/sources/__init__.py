"""Readers for the two logs, the event-table adapter and the mart sink."""
