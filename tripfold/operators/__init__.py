"""tripfold.operators."""
