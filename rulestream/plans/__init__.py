"""What a run should do, and the order in which it is done."""
