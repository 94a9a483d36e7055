"""Pure DataFrame -> DataFrame plans; no table on disk is needed."""
