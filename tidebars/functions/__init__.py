"""Column functions and the small numeric kernels used inside Arrow batches."""
