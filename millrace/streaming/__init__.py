"""The same work as a continuous job."""
