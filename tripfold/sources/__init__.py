"""tripfold.sources."""
