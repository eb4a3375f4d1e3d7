"""Writers, the load gate and the run log."""
