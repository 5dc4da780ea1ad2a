"""DataFrame operators, shared by batch runs and micro-batches."""
