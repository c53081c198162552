"""Reports over flights, retail, tracks, market and news tables, and runs of declared flows."""
