"""The library's operators run over the driver tables, with their SQL twins."""
