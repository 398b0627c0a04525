"""The registered queries on the driver tables and their SQL twins."""
