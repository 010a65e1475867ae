"""Feed readers, control files, file checks and table look-ups."""
