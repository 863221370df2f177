"""Everything that writes: tables, month replacement, layout, views, run log."""
