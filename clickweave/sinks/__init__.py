"""Writers with an exact write mode each: append, replace, upsert, sharded, binned."""
