"""Session-behaviour analytics as Spark DataFrame plans."""
