"""Reading and writing tables, and the declared schemas of the hand-off tables."""
