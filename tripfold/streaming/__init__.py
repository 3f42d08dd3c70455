"""tripfold.streaming."""
