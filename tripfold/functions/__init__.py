"""tripfold.functions."""
