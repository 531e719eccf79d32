"""Publishing: append, rebuild, insert-ignore, change-only upsert,
update-from, delete-by-key, reset and statistics (K1-K10)."""
