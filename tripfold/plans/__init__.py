"""tripfold.plans."""
