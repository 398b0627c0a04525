"""Result tables, replaced per task."""
