"""The test tables as raw files, every query over them, and SQL to check it with."""
