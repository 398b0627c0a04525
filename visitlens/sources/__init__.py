"""Where actions, users and tasks come from."""
