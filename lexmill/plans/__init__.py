"""Jobs: train, publish, re-evaluate and retrain."""
