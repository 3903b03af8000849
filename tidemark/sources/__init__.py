"""Reading feeds and statistics, and the tables they land in."""
